"""Token ids of whole texts by a ``tokenizers`` file, with the ids of words remembered."""

from __future__ import annotations

import json
import os
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Words remembered per worker process, and the longest of them.
REMEMBERED, REMEMBERED_CHARS = 300_000, 48
#: Bytes of text looked up at a time.
BLOCK = 8 << 20
#: ASCII letters, and ASCII marks but for the apostrophe, which begins contractions.
_LETTER, _MARK = np.zeros(256, dtype=bool), np.zeros(256, dtype=bool)
_LETTER[[*range(0x41, 0x5B), *range(0x61, 0x7B)]] = True
_MARK[[c for c in range(0x21, 0x7F) if not chr(c).isalnum() and chr(c) != "'"]] = True


class WordIds:
    """Ids of texts as little-endian bytes.

    If the file's pre-tokenizer keeps only matches of a pattern without white
    space, words apart by a space or line end never share a token; their ids are
    then looked up, and the library encodes new words only. Other files encode
    whole texts.
    """

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.model = Tokenizer.from_file(path)
        self.model.no_truncation()
        self.model.no_padding()
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        pre = spec.get("pre_tokenizer") or {}
        first = (pre.get("pretokenizers") or [pre])[0]
        pattern = (first.get("pattern") or {}).get("Regex", "")
        self.apart = first.get("type") == "Split" and first.get("invert") is True and first.get("behavior") == "Removed" and r"[^\s\p{L}\p{N}]+" in pattern
        steps = (spec.get("normalizer") or {}).get("normalizers") or [spec.get("normalizer") or {}]
        self.lowers = any(s.get("type") == "Lowercase" for s in steps)
        self.specials = [t["content"].lower() for t in spec.get("added_tokens") or []]
        self.dtype = np.dtype("<u2" if self.model.get_vocab_size() <= 1 << 16 else "<u4")
        # For words of letters in lower case: the same merges without normalizer and pattern.
        rest = (pre.get("pretokenizers") or [])[1:]
        self.lean = None
        if self.apart and [r.get("type") for r in rest] == ["ByteLevel"] and not rest[0].get("use_regex", True):
            lean = {**spec, "normalizer": None, "added_tokens": [], "pre_tokenizer": {"type": "Sequence", "pretokenizers": [{"type": "WhitespaceSplit"}, *rest]}}
            self.lean = Tokenizer.from_str(json.dumps(lean))
        suffix = spec["model"].get("end_of_word_suffix")
        self.ends = np.array([(self.model.id_to_token(i) or "").endswith(suffix) for i in range(self.model.get_vocab_size())]) if suffix else None
        self.words: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def _encoded(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, dtype=self.dtype).tobytes() for e in self.model.encode_batch_fast(texts, add_special_tokens=False)]

    def _encoded_words(self, words: list[str]) -> list[bytes]:
        """Ids of words of letters: joined by spaces, many at a time, and parted again after tokens that end a word."""
        if not words or self.ends is None:
            return self._encoded(words)
        joined = [" ".join(words[i : i + 512]) for i in range(0, len(words), 512)]
        plain = self.lean is not None and all(self._lowered(j) == j and j.encode("latin-1", "ignore").decode("latin-1") == j for j in joined)
        model = self.lean if plain else self.model
        ids = np.concatenate([np.array(e.ids, dtype=self.dtype) for e in model.encode_batch_fast(joined, add_special_tokens=False)])
        last = np.flatnonzero(self.ends[ids])
        if len(last) != len(words):
            return self._encoded(words)
        raw, cuts = ids.tobytes(), [0, *((last + 1) * self.dtype.itemsize).tolist()]
        return [raw[a:b] for a, b in zip(cuts, cuts[1:], strict=False)]

    def _special(self, text: str) -> bool:
        """Whether a special token's string may stand in the text; it takes precedence over the pattern."""
        return any(s in low for low in [text.lower()] for s in self.specials)

    def _lowered(self, text: str) -> str:
        """The text in lower case, if the normaliser does no more to it.

        Up to U+00FF nothing composes with its neighbours, and lower case is a matter of single characters.
        """
        if not self.lowers:
            return text
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:
            return text
        return text.lower()

    def _learnt(self, words: list[str]) -> dict[str, bytes]:
        """Ids of new words by the library."""
        letters = [w for w in words if w.isalpha()]
        rest = [w for w in words if not w.isalpha()]
        return {**dict(zip(letters, self._encoded_words(letters), strict=True)), **dict(zip(rest, self._encoded(rest), strict=True))}

    def _known(self, words: list[str]) -> list[bytes]:
        """Ids of distinct words. Words looked up lately stay remembered: two generations, the older one goes when the younger is full."""
        young, old = self.words, self.older
        found = list(map(young.get, words))
        unseen = [i for i, f in enumerate(found) if f is None]
        if unseen:
            earlier = {words[i]: f for i in unseen if (f := old.get(words[i])) is not None}
            new = self._learnt([words[i] for i in unseen if words[i] not in earlier])
            for i in unseen:
                found[i] = earlier.get(words[i]) or new.get(words[i]) or b""
            young.update(earlier)
            young.update((w, f) for w, f in new.items() if len(w) <= REMEMBERED_CHARS)
        if len(young) > REMEMBERED // 2:
            self.words, self.older = {}, young
        return found

    def _looked_up(self, texts: list[bytes]) -> list[bytes]:
        """Ids of texts whose words are independent: words are cut and numbered as columns, their ids gathered.

        Words end at a space or line end, and where an ASCII mark other than an
        apostrophe follows a letter up to U+00FF: there a match of the pattern ends.
        """
        data = np.frombuffer(b" ".join(texts), dtype=np.uint8)
        kept = (data != 0x20) & (data != 0x0A)
        letter = _LETTER[data]
        high = np.flatnonzero(data == 0xC3)
        high = high[high + 1 < len(data)]
        letter[high + 1] = (data[high + 1] != 0x97) & (data[high + 1] != 0xB7)
        starts = kept.copy()
        starts[1:] &= ~kept[:-1] | (letter[:-1] & _MARK[data[1:]])
        places = np.flatnonzero(starts)
        text_ends = np.cumsum([len(t) + 1 for t in texts])
        if not len(places):
            return [b""] * len(texts)
        words_before = np.searchsorted(places, text_ends)
        offsets = np.append(np.flatnonzero(starts[kept]), int(kept.sum())).astype(np.int32)
        words = pa.StringArray.from_buffers(len(places), pa.py_buffer(offsets), pa.py_buffer(data[kept]))
        coded = pc.dictionary_encode(words)
        found = self._known(coded.dictionary.to_pylist())
        lengths = np.fromiter(map(len, found), dtype=np.int32, count=len(found)) // self.dtype.itemsize
        firsts = np.cumsum(lengths, dtype=np.int32) - lengths
        flat = np.frombuffer(b"".join(found), dtype=self.dtype)
        index = coded.indices.to_numpy()
        n = lengths[index]
        ends = np.cumsum(n, dtype=np.int32)
        at = np.repeat(firsts[index] - ends + n, n)
        at += np.arange(len(at), dtype=np.int32)
        raw = flat[at].tobytes()
        cuts = (np.append(np.int32(0), ends)[words_before].astype(np.int64) * self.dtype.itemsize).tolist()
        return [raw[a:b] for a, b in zip([0, *cuts], cuts, strict=False)]

    def encode_many(self, texts: list[str]) -> list[bytes]:
        """Ids of each text; texts beyond BLOCK go in blocks that end at a space, so that little more than the ids is held."""
        if not self.apart:
            return self._encoded(texts)
        out: list[bytes] = []
        group: list[bytes] = []
        size = 0
        for text in texts:
            if self._special(text):
                out += self._looked_up(group) if group else []
                out += self._encoded([text])
                group, size = [], 0
                continue
            raw = self._lowered(text).encode()
            if group and size + len(raw) > BLOCK:
                out += self._looked_up(group)
                group, size = [], 0
            if len(raw) > BLOCK:
                out.append(b"".join(self._looked_up([block])[0] for block in _blocks(raw)))
                continue
            group.append(raw)
            size += len(raw)
        return out + self._looked_up(group) if group else out


def _blocks(text: bytes) -> Iterator[bytes]:
    """A text in blocks of about BLOCK bytes, cut at spaces; the space of a cut is left out."""
    at = 0
    while at < len(text):
        end = text.find(b" ", at + BLOCK)
        end = len(text) if end < 0 else end
        yield text[at:end]
        at = end + 1


@lru_cache(maxsize=2)
def word_ids(path: str) -> WordIds:
    """One coder per worker process."""
    return WordIds(path)
