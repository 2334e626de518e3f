"""Token counts as a tokenizer library gives them, huge documents in overlapping chunks."""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from reelmetry.llm.common import slices, strings

#: Texts above this many characters are encoded in chunks of it; neighbours overlap.
CHUNK, OVERLAP = 1 << 15, 256

#: (id, start, end) of a token, in characters of the text given to the encoder.
Token = tuple[int, int, int]


class PieceCounter:
    """Counts for a sentencepiece BPE model.

    Merging is local: a list of tokens is the encoding of its text exactly if each
    two neighbours are. If the encodings of two overlapping chunks share a token
    (same id, same place), then the left list up to it and the right list after it
    have only neighbours that one of the two encodings has; so the spliced list is
    the encoding of the joined text. That makes any shared token a proven boundary.
    """

    def __init__(self, path: str) -> None:
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        #: The normaliser puts a space before a text; it isn't part of a chunk that starts inside one.
        self.shift = 1
        probe = " a  b\n ﬁ①"
        self.plain = self.model.decode(self.model.encode(probe)) == probe  # the normaliser changes nothing
        pieces = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        # Characters a token covers; of the byte tokens of a character, the first covers it.
        self.chars = np.array([
            (0x80 <= int(p[1:-1], 16) < 0xC0) ^ 1 if self.model.is_byte(i) else len(p) for i, p in enumerate(pieces)
        ])

    def count_many(self, texts: list[str]) -> list[int]:
        return [len(ids) for ids in self.model.encode(texts, num_threads=1)]

    def tokens(self, text: str) -> list[Token]:
        """Tokens of a chunk with places; the space that the normaliser puts first is at -1."""
        ids = self.model.encode(text)
        ends = np.cumsum(self.chars[ids]) - self.shift
        return list(zip(ids, (ends - self.chars[ids]).tolist(), ends.tolist(), strict=True))

    def splice(self, left: list[Token], right: list[Token], margin: int) -> tuple[int, int] | None:
        """Indexes of a shared token in both lists (places on one scale), or None. ``margin``: where trust in the right list may begin."""
        places = {t: i for i, t in enumerate(left)}
        for j, t in enumerate(right):
            # Behind the chunk's own first space; not a byte token, of which several share a place.
            if t[1] >= margin and t in places and not self.model.is_byte(t[0]):
                return places[t], j
        return None


class FastCounter:
    """Counts for a ``tokenizers`` file whose words are found by one left-to-right scan.

    A scan forgets what lies before a word's start. A word start that both chunks'
    scans have, with another word after it inside the left chunk, is a proven
    boundary. A file with a normalizer or another pre-tokenizer than byte level is
    encoded in one go, whatever the length.
    """

    shift = 0

    def __init__(self, path: str) -> None:
        import json

        from tokenizers import Tokenizer

        self.model = Tokenizer.from_file(path)
        self.model.no_truncation()
        self.model.no_padding()
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        pre = spec.get("pre_tokenizer") or {}
        specials = spec.get("added_tokens") or []
        self.plain = not spec.get("normalizer") and pre.get("type") == "ByteLevel" and pre.get("use_regex", True) and not pre.get(
            "add_prefix_space") and all(t["content"] for t in specials)
        self.specials = [t["content"] for t in specials]

    def count_many(self, texts: list[str]) -> list[int]:
        return [len(e.ids) for e in self.model.encode_batch_fast(texts, add_special_tokens=False)]

    def tokens(self, text: str) -> list[Token]:
        found = self.model.encode(text, add_special_tokens=False)
        return [(i, *place) for i, place in zip(found.ids, found.offsets, strict=True)]

    def splice(self, left: list[Token], right: list[Token], margin: int) -> tuple[int, int] | None:
        starts: dict[int, int] = {}
        for i, t in enumerate(left):
            starts.setdefault(t[1], i)
        last = left[-1][1] if left else 0
        for j in range(1, len(right) - 1):
            t, before = right[j], right[j - 1]
            if t[1] < margin or t[1] not in starts or before[2] != t[1]:
                continue
            i = starts[t[1]]
            # A token that a space begins starts a word in both scans; so must the next few, well inside the left chunk.
            agree = left[i : i + 4] == right[j : j + 4] and len(left) - i > 8 and last > t[1] + 16
            if agree and i and left[i - 1] == before and self.begins_word(t[0]):
                return i, j
        return None

    @lru_cache(maxsize=100_000)  # noqa: B019  one counter per worker process
    def begins_word(self, token: int) -> bool:
        return bool(re.fullmatch(r"Ġ\w+", self.model.id_to_token(token) or ""))


@lru_cache(maxsize=2)
def counter(path: str) -> PieceCounter | FastCounter:
    return PieceCounter(path) if path.endswith(".model") else FastCounter(path)


def spliced_count(text: str, coder: PieceCounter | FastCounter, chunk: int = CHUNK, overlap: int = OVERLAP) -> int:
    """Tokens of a text of any length from overlapping chunks.

    Each chunk but the first starts ``overlap`` characters before the end of the
    last one. If the two encodings have no proven common boundary there, the next
    chunk starts twice as far back, and so on to the whole chunk; if that fails
    too, the chunk itself grows. At the worst the text is encoded in one go.
    """
    if len(text) <= chunk or not coder.plain:
        return coder.count_many([text])[0]
    start, end = 0, chunk
    done = 0  # tokens before the current list
    current = coder.tokens(text[:end])
    while end < len(text):
        back = overlap
        while True:
            begin = max(start, end - back)
            if begin == start and back >= end - start:  # the whole last chunk didn't help: a longer one, encoded anew
                end = min(len(text), end + (end - start))
                fresh = coder.tokens(text[start:end])
                if start:
                    fresh = [(i, a + start, b + start) for i, a, b in fresh]
                    joined = coder.splice(current, fresh, start + coder.shift)
                    if joined is None:  # give up: the rest of the proof needs the beginning
                        return coder.count_many([text])[0]
                    done += joined[0]
                    current = fresh[joined[1]:]
                else:
                    done, current = 0, fresh
                break
            stop = min(len(text), begin + chunk)
            right = [(i, a + begin, b + begin) for i, a, b in coder.tokens(text[begin:stop])]
            joined = coder.splice(current, right, begin + coder.shift)
            if joined is not None:
                done += joined[0]
                current = right[joined[1]:]
                start, end = begin, stop
                break
            back *= 2
    return done + len(current)


def count_tokens(docs: DataFrame, path: str, limit: int = 4096, chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """``doc_id``, ``n_bytes``, ``n_tokens`` and ``over_limit`` of every whole ``text``.

    ``path`` is a ``tokenizers`` (.json) or a ``sentencepiece`` (.model) file that
    the executors can read. Tokens are counted as the library gives them, without
    begin, end or added tokens. Null and empty texts count 0; repeated rows repeat;
    other columns are ignored; an empty table gives no rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = counter(path)
        for batch in slices(batches, "text"):
            texts = strings(batch.column("text"))
            short = [t for t in texts if len(t) <= chunk]
            counts = iter(coder.count_many(short) if short else [])
            n = [next(counts) if len(t) <= chunk else spliced_count(t, coder, chunk, overlap) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([len(t.encode()) for t in texts], pa.int64()), pa.array(n, pa.int64()),
                 pa.array([k > limit for k in n], pa.bool_())],
                names=["doc_id", "n_bytes", "n_tokens", "over_limit"],
            )

    return docs.select(docs["doc_id"].cast("long"), docs["text"].cast("string")).mapInArrow(
        run, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")
