"""Spelling variants: near words by a trie of letter-group counts, and the commoner form each belongs to."""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelmetry.llm.common import slices, strings
from reelmetry.operators.skew import store

#: Letter groups, one level of the trie each; all other letters are the last level. Common letters first, as they tell most words apart.
GROUPS = ("e", "a", "i", "n", "r", "s", "t", "o", "l", "d", "u", "cm", "hp", "bfgv", "jkqwxyz")
LEVELS = len(GROUPS) + 1
#: Words of one part of the trie (what a task holds), words looked up in it by one task, and words of a leaf.
PART_WORDS, PART_QUERIES, LEAF_WORDS = 20_000, 100_000, 4
#: Words counted in a task before they are passed on, and characters of a text taken at a time.
COUNTED, PIECE = 200_000, 4 << 20
#: A form has at least this many times a word's occurrences.
RATIO = 5
#: Longest chain of forms: each has RATIO times the occurrences of the one before, and a count is below 2**63; so many doublings cover it.
DOUBLINGS = 5

_CAPITALS = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_OTHER = re.compile("[^a-zÀ-ÿ]")


def _pieces(text: str) -> Iterator[str]:
    """A text in pieces that end outside words."""
    at = 0
    while len(text) - at > PIECE:
        cut = _OTHER.search(text, at + PIECE)
        end = cut.start() if cut else len(text)
        yield text[at:end]
        at = end
    yield text[at:]


def word_counts(docs: DataFrame, least_length: int = 6, least_count: int = 5, delete_one_in: int = 199) -> DataFrame:
    """``word`` and ``n`` of the words that occur ``least_count`` times or more in the whole texts.

    A word is a maximal run of letters A-Z, a-z and U+00C0 to U+00FF, of which A-Z
    are lower-cased. If ``delete_one_in`` divides the crc32 h of ``doc_id:run``, code
    point h % length is deleted. Null texts hold no words, a null ``doc_id`` is empty
    in the hash; repeated rows count each. Tasks add up before the shuffle, and pass
    on their counts whenever COUNTED words are held.
    """
    run = re.compile(f"[a-zÀ-ÿ]{{{least_length},}}")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, int] = {}

        def batch_of() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())], names=["word", "n"])

        for batch in slices(batches, "text"):
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), strings(batch.column("text")), strict=True):
                lowered = text.encode().translate(_CAPITALS).decode()
                head = zlib.crc32(b":" if doc_id is None else b"%d:" % doc_id)
                for piece in _pieces(lowered):
                    for word, n in Counter(run.findall(piece)).items():
                        h = zlib.crc32(word.encode(), head)
                        if h % delete_one_in == 0:
                            at = h % len(word)
                            word = word[:at] + word[at + 1 :]
                            if len(word) < least_length:
                                continue
                        held[word] = held.get(word, 0) + n
                if len(held) > COUNTED:
                    yield batch_of()
                    held = {}
        if held:
            yield batch_of()

    texts = docs.select(docs["doc_id"].cast("long"), docs["text"].cast("string")).where("text IS NOT NULL")
    return texts.mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_count)


def letter_counts(word: str) -> Column:
    """How often each letter group stands in a word, a byte each (255 for more): the path of its leaf in the trie.

    A cut count only brings words nearer to each other, so no near word is lost.
    """
    length = F.length(word)
    found = [length - F.length(F.translate(F.col(word), group, "")) for group in GROUPS]
    found.append(F.length(F.translate(F.col(word), "".join(GROUPS), "")))
    return F.unhex(F.concat(*[F.lpad(F.hex(F.least(c, F.lit(255)).cast("long")), 2, "0") for c in found]))


def one_edit(a: str, b: str) -> bool:
    """Whether two words differ by exactly one inserted, deleted or replaced code point."""
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    half = (len(a) - 1) // 2
    if a[:half] != b[:half] and (not half or a[-half:] != b[-half:]):
        return False
    at = 0
    while at < len(a) and a[at] == b[at]:
        at += 1
    return a[at + 1 :] == b[at + 1 :] if len(a) == len(b) else a[at:] == b[at + 1 :]


class Trie:
    """Words by their letter-group counts from a level on; small branches are leaves."""

    def __init__(self, words: list[tuple[bytes, str, int]], level: int = 0) -> None:
        self.level = level
        self.root = self._node(words, level)

    def _node(self, words: list[tuple[bytes, str, int]], level: int) -> dict | list:
        if level == LEVELS or len(words) <= LEAF_WORDS:
            return [(word, n) for _, word, n in words]
        branches: dict[int, list] = {}
        for entry in words:
            branches.setdefault(entry[0][level], []).append(entry)
        return {count: self._node(own, level + 1) for count, own in branches.items()}

    def near(self, counts: bytes, word: str, surplus: int = 1, deficit: int = 1) -> list[tuple[str, int]]:
        """Words one edit away, each pair of words from one side only.

        Depth first, over branches that spend a surplus of one letter and then a
        deficit of one. Of two near words with different counts one sees the surplus
        first, and it finds the other; with equal counts as far as a leaf, the
        smaller word does.
        """
        out = []
        stack = [(self.root, self.level, surplus, deficit)]
        while stack:
            node, level, more, less = stack.pop()
            if isinstance(node, list):
                out += [entry for entry in node if (not more or word < entry[0]) and one_edit(word, entry[0])]
                continue
            count = counts[level]
            level += 1
            if (child := node.get(count)) is not None:
                stack.append((child, level, more, less))
            if more:
                if (child := node.get(count + 1)) is not None:
                    stack.append((child, level, 0, less))
            elif less and (child := node.get(count - 1)) is not None:
                stack.append((child, level, 0, 0))
        return out


_PAIR = "word string, near string, rank long"


def _look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Parts of the trie, each followed by the words that are looked up in it: pairs of near words, in both directions."""
    part = trie = None
    stored: list[tuple[bytes, str, int]] = []
    for batch in batches:
        left, right, rank = [], [], []
        columns = [batch.column(c).to_pylist() for c in ("path", "piece", "salt", "level", "kind", "counts", "word", "n", "more", "less")]
        for path, piece, salt, level, query, counts, word, n, more, less in zip(*columns, strict=True):
            if part != (path, piece, salt):
                part, trie, stored = (path, piece, salt), None, []
            if not query:
                stored.append((counts, word, n))
                continue
            if trie is None:
                trie, stored = Trie(stored, level), []
            for other, m in trie.near(counts, word, more, less):
                left += (word, other)
                right += (other, word)
                rank += (-m, -n)
        if left:
            yield pa.RecordBatch.from_arrays([pa.array(left, pa.string()), pa.array(right, pa.string()), pa.array(rank, pa.int64())], names=["word", "near", "rank"])


def near_words(words: DataFrame) -> DataFrame:
    """For each word of ``word``, ``n`` that has near words: ``word``, ``near`` (how many) and ``best`` (-n and word of the commonest).

    The trie of all words is cut into parts: the highest nodes with at most
    PART_WORDS words. The nodes above them are few (at most LEVELS x words /
    PART_WORDS); the search walks them for all words at once, a join per level with
    the nodes that exist, each state carrying what is left of its surplus and
    deficit. It arrives at parts, whose remaining levels a task searches depth
    first. A part that many words arrive at is copied for PART_QUERIES of them each,
    and a bottom node with too many words is cut into pieces that all its searches
    visit, so a task's memory is bounded for any words.
    """
    words = store(words.withColumn("counts", letter_counts("word")), "words")
    # A node is its level and the first so many bytes of the counts.
    nodes = store(words.select("counts", F.explode(F.sequence(F.lit(1), F.lit(LEVELS))).alias("level"))
                  .groupBy("level", F.expr("substring(counts, 1, level)").alias("path")).agg(F.count(F.lit(1)).alias("words")), "nodes")
    deepest = nodes.where(F.col("words") > PART_WORDS).agg(F.max("level")).first()[0] or 0

    found: list[DataFrame] = []
    state = words.select("word", "n", "counts", F.unhex(F.lit("")).alias("path"), F.lit(1).alias("more"), F.lit(1).alias("less"))
    for level in range(1, min(deepest + 1, LEVELS) + 1):
        count = F.conv(F.hex(F.substring("counts", level, 1)), 16, 10).cast("int")
        moved = state.withColumn("step", F.explode(F.array(F.lit(0), F.lit(1), F.lit(-1)))).withColumn("count", count + F.col("step"))
        moved = moved.where("(step < 1 OR more = 1) AND (step > -1 OR (more = 0 AND less = 1)) AND count BETWEEN 0 AND 255").select(
            "word", "n", "counts", F.concat("path", F.unhex(F.lpad(F.hex(F.col("count").cast("long")), 2, "0"))).alias("path"),
            (F.col("more") - (F.col("step") == 1).cast("int")).alias("more"), (F.col("less") - (F.col("step") == -1).cast("int")).alias("less"),
        )
        met = moved.join(nodes.where(F.col("level") == level).select("path", F.col("words").alias("held")), "path")
        bottom = (F.col("held") <= PART_WORDS) | F.lit(level == LEVELS)
        found.append(met.where(bottom).select("path", F.lit(level).alias("level"), "word", "n", "counts", "more", "less", "held"))
        state = store(met.where(~bottom).drop("held"), "search") if level <= deepest and level < LEVELS else None
    arrived = found[0]
    for more in found[1:]:
        arrived = arrived.unionByName(more)
    arrived = store(arrived, "arrived")

    parts = arrived.groupBy("path", "level").agg(F.count(F.lit(1)).alias("queries"), F.first("held").alias("held"))
    parts = parts.select(
        "path", "level", F.ceil(F.col("held") / PART_WORDS).cast("int").alias("pieces"), F.ceil(F.col("queries") / PART_QUERIES).cast("int").alias("salts"))
    spot = F.xxhash64("word")

    def every(c: str) -> Column:
        return F.explode(F.sequence(F.lit(0), F.col(c) - 1))

    # A word is stored in the part where its own search arrives with all of its budget unspent.
    own = arrived.where("more = 1 AND less = 1").select("path", "word", "n", "counts").join(parts, "path")
    own = own.withColumns({"piece": F.pmod(spot, "pieces").cast("int"), "salt": every("salts"), "kind": F.lit(0), "more": F.lit(0), "less": F.lit(0)})
    asked = arrived.drop("held", "level").join(parts, "path")
    asked = asked.withColumns({"salt": F.pmod(spot, "salts").cast("int"), "piece": every("pieces"), "kind": F.lit(1)})
    columns = ["path", "piece", "salt", "level", "kind", "counts", "word", "n", "more", "less"]
    dealt = own.select(columns).unionByName(asked.select(columns))
    count = max(int(words.sparkSession.conf.get("spark.sql.shuffle.partitions", "200")), 1)
    dealt = dealt.repartition(count, "path", "piece", "salt").sortWithinPartitions("path", "piece", "salt", "kind", "word")
    pairs = dealt.mapInArrow(_look_up, _PAIR)
    return pairs.groupBy("word").agg(F.count(F.lit(1)).alias("near"), F.min(F.struct("rank", F.col("near").alias("word"))).alias("best"))


def roots(links: DataFrame) -> DataFrame:
    """Follows ``form`` from every ``word`` to the last; ``word`` and ``root``. Doubles the steps per join until none goes on."""
    now = store(links.select("word", F.col("form").alias("root")), "roots")
    for _ in range(DOUBLINGS):
        further = now.select(F.col("word").alias("root"), F.col("root").alias("further"))
        now = store(now.join(further, "root", "left").select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")), "roots")
        if now.where("moved").isEmpty():
            break
        now = now.drop("moved")
    return now.select("word", "root")


def group_variants(docs: DataFrame, least_length: int = 6, least_count: int = 5, delete_one_in: int = 199) -> DataFrame:
    """Spelling variants among the words of ``docs``; one row per word (see ``word_counts``).

    ``form`` is the near word with the most occurrences (ties: the smallest in
    code-point order), if it has RATIO times the word's or more, else null; ``root``
    is where the forms lead, the word itself if it has none. ``n``, ``n_near`` (near
    words) and ``form_n`` are counts. An empty table, or one without such words,
    gives no rows; columns other than ``doc_id`` and ``text`` are ignored.
    """
    words = store(word_counts(docs, least_length, least_count, delete_one_in), "counted")
    common = -F.col("best.rank") >= RATIO * F.col("n")
    joined = words.join(near_words(words), "word", "left").select(
        "word", F.when(common, F.col("best.word")).alias("form"), "n", F.coalesce("near", F.lit(0).cast("long")).alias("n_near"),
        F.when(common, -F.col("best.rank")).alias("form_n"))
    linked = store(joined, "linked")
    ends = roots(linked.where("form IS NOT NULL"))
    return linked.join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
