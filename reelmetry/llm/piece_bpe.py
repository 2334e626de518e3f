"""SentencePiece encoding of merge-type (BPE) models by backtracking, and decoding.

The library's own encoder isn't used: the vocabulary alone is read from the model.
"""

from __future__ import annotations

import codecs
import hashlib
import re
from collections.abc import Iterable, Iterator
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from reelmetry.llm.common import slices, strings

#: The character that stands for a space in pieces.
SPACE = "▁"
#: Chunks up to this length are remembered, so many at most.
REMEMBERED_CHARS, REMEMBERED = 64, 700_000

codecs.register_error("each_byte", lambda e: ("�" * (e.end - e.start), e.end))


class PieceEncoder:
    """Encoder and decoder of one model with byte fallback.

    A list of pieces is the model's encoding of its text exactly if every two
    neighbours, joined and merged anew, fall apart into the same two pieces. The
    encoder takes the longest piece at each place (one Aho-Corasick pass), goes to
    the next shorter one while its end is known to fail or it doesn't fit its left
    neighbour, and steps back when none is left; a bitfield keeps failed places,
    so that each is tried once.
    """

    def __init__(self, path: str) -> None:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        count = model.get_piece_size()
        self.byte_ids: dict[int, int] = {}
        self.surface: list[bytes] = []
        pieces: dict[str, int] = {}
        for i in range(count):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                value = int(piece[1:-1], 16)
                self.byte_ids[value] = i
                self.surface.append(bytes([value]))
            elif model.is_control(i):
                self.surface.append(b"")
            elif model.is_unknown(i):
                self.surface.append(" ⁇ ".encode())
            else:
                pieces[piece] = i
                self.surface.append(piece.replace(SPACE, " ").encode())
        if len(self.byte_ids) < 256:
            raise ValueError("the model has no byte fallback")
        self.ids = pieces
        self.rank = {p: -model.get_score(i) for p, i in pieces.items()}
        # Pieces that merging their own characters doesn't give back never occur.
        whole = {p for p in pieces if len(p) == 1 or self.merged(p) == [p]}
        self.shorter: dict[str, str] = {}
        self.automaton = ahocorasick.Automaton()
        # The automaton looks through a node's letters in the order they came; the model's order begins with the common ones.
        for p in (p for p in pieces if p in whole):
            self.automaton.add_word(p, p)
            self.shorter[p] = next((p[:k] for k in range(len(p) - 1, 0, -1) if p[:k] in whole or k == 1), "")
        self.automaton.make_automaton()
        # Text may be cut before a space that follows something else, and around characters of no longer piece.
        longer = [p for p in pieces if len(p) > 1]
        self.cuts_at_spaces = not any(SPACE in p.lstrip(SPACE) for p in longer)
        letters = "".join(re.escape(c) for c in sorted({c for p in longer for c in p}))
        self.runs = re.compile(f"[{letters}]+|[^{letters}]")
        self.fits: dict[tuple[str, str], bool] = {}
        self.known: dict[str, tuple[str, bytes]] = {}

    def merged(self, text: str) -> list[str]:
        """The definition: merge the best-ranked neighbours, leftmost first, until none is a piece."""
        parts, rank, never = list(text), self.rank.get, float("inf")
        ranks = [rank(a + b, never) for a, b in zip(parts, parts[1:])]
        while ranks:
            best = min(ranks)
            if best == never:
                break
            at = ranks.index(best)
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
            del ranks[at]
            # Only the two new neighbourhoods are ranked anew.
            if at:
                ranks[at - 1] = rank(parts[at - 1] + parts[at], never)
            if at < len(ranks):
                ranks[at] = rank(parts[at] + parts[at + 1], never)
        return parts

    def compatible(self, left: str, right: str) -> bool:
        known = self.fits.get((left, right))
        if known is None:
            if len(self.fits) >= REMEMBERED:
                self.fits.clear()
            known = self.fits[(left, right)] = self.merged(left + right) == [left, right]
        return known

    def backtracked(self, text: str) -> list[str]:
        """The pieces of a text (spaces already replaced)."""
        longest = list(text)
        for end, piece in self.automaton.iter(text):
            longest[end + 1 - len(piece)] = piece  # later ends are longer
        size, at, out = len(text), 0, []
        failed = bytearray((size >> 3) + 1)
        piece, left = longest[0] if size else "", ""
        shorter, fits, stepped_back = self.shorter, self.fits, False
        while at < size:
            end = at + len(piece)
            if stepped_back and failed[end >> 3] >> (end & 7) & 1:
                fit = False
            elif left:
                fit = fits.get((left, piece))
                if fit is None:
                    fit = self.compatible(left, piece)
            else:
                fit = True
            if fit:
                out.append(piece)
                left, at = piece, end
                piece = longest[at] if at < size else ""
            elif len(piece) > 1:
                piece = shorter[piece]
            else:
                failed[at >> 3] |= 1 << (at & 7)
                stepped_back = True
                piece = out.pop()
                left = out[-1] if out else ""
                at -= len(piece)
        return out

    def piece_ids(self, pieces: Iterable[str]) -> list[int]:
        ids: list[int] = []
        for p in pieces:
            known = self.ids.get(p)
            if known is None:
                ids.extend(self.byte_ids[b] for b in p.encode())
            else:
                ids.append(known)
        return ids

    def chunks(self, text: str) -> list[str]:
        """The text with its leading space, cut where no piece can reach across."""
        if not text:
            return []
        marked = SPACE + text.replace(" ", SPACE)
        if not self.cuts_at_spaces:
            return [marked]
        if SPACE * 2 in marked or marked.endswith(SPACE):
            return re.findall(f"{SPACE}*[^{SPACE}]+|{SPACE}+", marked)
        return [SPACE + w for w in marked[1:].split(SPACE)]

    def chunk_ids(self, chunk: str) -> list[int]:
        return [i for run in self.runs.findall(chunk) for i in self.piece_ids(self.backtracked(run))]

    def encode(self, text: str) -> list[int]:
        """The ids of a text, as the model defines them, without begin or end."""
        return [i for c in self.chunks(text) for i in self.chunk_ids(c)]

    def finished(self, raw: bytes) -> str:
        return (raw[1:] if raw[:1] == b" " else raw).decode("utf-8", "each_byte")

    def decode(self, ids: Iterable[int]) -> str:
        """The text of ids: pieces joined, the leading space taken off, bytes read as UTF-8."""
        surface = self.surface
        return self.finished(b"".join([surface[i] for i in ids]))

    def described(self, text: str) -> tuple[str, str]:
        """The ids in decimal, comma-joined, and their decoded text; short chunks are remembered."""
        known, surface = self.known, self.surface
        chunks = self.chunks(text)
        described = list(map(known.get, chunks))
        at = -1
        for _ in range(described.count(None)):
            at = described.index(None, at + 1)
            c = chunks[at]
            both = known.get(c)  # an earlier chunk of this text may be the same
            if both is None:
                found = self.chunk_ids(c)
                both = (",".join(map(str, found)), b"".join([surface[i] for i in found]))
                if len(c) <= REMEMBERED_CHARS:
                    if len(known) >= REMEMBERED:
                        known.clear()
                    known[c] = both
            described[at] = both
        ids, raw = [d[0] for d in described], [d[1] for d in described]
        return ",".join(ids), self.finished(b"".join(raw))


@lru_cache(maxsize=2)
def encoder(path: str) -> PieceEncoder:
    """One encoder per worker process."""
    return PieceEncoder(path)


def encode_documents(docs: DataFrame, path: str) -> DataFrame:
    """``doc_id``, ``ids`` (array of int) and ``decoded`` (the text of the ids) of every whole ``text``.

    Null and empty texts have no ids and an empty decoded text; repeated rows
    repeat; other columns are ignored; an empty table gives no rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(path)
        for batch in slices(batches, "text"):
            ids, decoded = [], []
            for text in strings(batch.column("text")):
                joined, back = coder.described(text)
                ids.append(np.array(joined.split(","), dtype=np.int32) if joined else np.empty(0, np.int32))
                decoded.append(back)
            offsets = np.cumsum([0, *map(len, ids)]).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(ids)))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), lists, pa.array(decoded, pa.string())], names=["doc_id", "ids", "decoded"])

    return docs.select(docs["doc_id"].cast("long"), docs["text"].cast("string")).mapInArrow(run, "doc_id long, ids array<int>, decoded string")


def encoding_digests(docs: DataFrame, path: str) -> DataFrame:
    """``doc_id``, ``n_tokens``, ``ids_sha256``, ``decoded_sha256`` of every whole ``text``.

    The digests of ``encode_documents``, taken in the task, so that the ids needn't
    leave it. Null and empty texts have 0 tokens and the digest of nothing.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(path)
        for batch in slices(batches, "text"):
            n, ids, decoded = [], [], []
            for text in strings(batch.column("text")):
                joined, back = coder.described(text)
                n.append(joined.count(",") + 1 if joined else 0)
                ids.append(hashlib.sha256(joined.encode()).hexdigest())
                decoded.append(hashlib.sha256(back.encode()).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(ids, pa.string()), pa.array(decoded, pa.string())],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    return docs.select(docs["doc_id"].cast("long"), docs["text"].cast("string")).mapInArrow(
        run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
