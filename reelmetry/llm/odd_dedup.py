"""Near-duplicate documents: MinHash bands, odd sketches, confirmation on full sets."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelmetry.llm.common import U64, constants, mix, slices, task_keys, utf8, word_hashes
from reelmetry.llm.components import connected_components
from reelmetry.operators.skew import keep_listed, store_and_release

SHINGLE = 5
#: A link needs 100 * intersection >= PERCENT * union.
PERCENT = 85
#: Rounds of further pivots, taken while more comparisons than these per node would be left and this share of a round's pairs are links.
MORE_PIVOTS, PAIRS_PER_NODE, LEAST_LINKED = 6, 4, 0.05
#: 32 bands of 5 samples: a pair at similarity 0.85 meets in no band with probability (1 - 0.85**5)**32 < 1e-8.
BANDS, ROWS = 32, 5
SAMPLES = BANDS * ROWS
#: Bits of an odd sketch. Two sets of samples that differ in d elements differ in about n/2 * (1 - exp(-2d/n)) bits.
SKETCH_BITS = 512
#: Estimated similarity below which a candidate isn't confirmed: six standard errors of SAMPLES samples below the threshold.
MARGIN = 6


def shingle_set(words: np.ndarray, size: int = SHINGLE) -> np.ndarray:
    """Sorted distinct hashes of a document's runs of ``size`` words; with fewer words, of all of them as one."""
    factors = constants(size, 5)
    if len(words) < size:
        return mix(np.sum(words * factors[: len(words)], dtype=U64, keepdims=True) + U64(len(words))) if len(words) else words
    last = len(words) - size + 1
    total = words[:last] * factors[0]
    for j in range(1, size):
        total += words[j : j + last] * factors[j]
    return np.unique(mix(total))


def minhash(shingles: np.ndarray) -> np.ndarray:
    """SAMPLES minima of the set under as many multiply-add permutations."""
    a, b = constants(SAMPLES, 11)[:, None], constants(SAMPLES, 13)[:, None]
    least = np.full(SAMPLES, np.iinfo(U64).max, dtype=U64)
    for at in range(0, len(shingles), 1024):
        part = a * shingles[None, at : at + 1024]
        part += b
        np.minimum(least, part.min(axis=1), out=least)
    return least


def band_keys(samples: np.ndarray) -> np.ndarray:
    """One key per band; the band's number is part of it."""
    return mix((samples * constants(SAMPLES, 17)).reshape(BANDS, ROWS).sum(axis=1, dtype=U64) + constants(BANDS, 19))


def odd_sketch(samples: np.ndarray) -> np.ndarray:
    """The samples, each with its number, folded into a bitmap of parities, as 64-bit words."""
    bit = (mix(samples ^ constants(SAMPLES, 23)) >> U64(64 - int(math.log2(SKETCH_BITS)))).astype(np.int64)
    parity = (np.bincount(bit, minlength=SKETCH_BITS) & 1).astype(np.uint8)
    return np.packbits(parity).view(">u8").astype(U64)


def most_odd_bits(percent: int = PERCENT) -> int:
    """Differing bits up to which two sketches may belong to a linked pair."""
    j = percent / 100
    lowest = max(0.0, j - MARGIN * math.sqrt(j * (1 - j) / SAMPLES) * 1.15)
    differ = 2 * SAMPLES * (1 - lowest)
    return math.ceil(SKETCH_BITS / 2 * (1 - math.exp(-2 * differ / SKETCH_BITS)))


_SIGNATURE = "row long, doc_id long, text_hash long, n_shingles long, set_key binary, bands array<long>, sketch array<long>"


def _signatures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    keys = task_keys()
    for batch in slices(batches, "text"):
        n, set_keys, bands, sketches = [], [], [], []
        for words in word_hashes(utf8(batch.column("text"))):
            found = shingle_set(words)
            n.append(len(found))
            set_keys.append(_set_key(found))
            samples = minhash(found)
            bands.append(band_keys(samples).view(np.int64))
            sketches.append(odd_sketch(samples).view(np.int64))
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(keys(batch.num_rows)), batch.column("doc_id"), batch.column("text_hash"), pa.array(n, pa.int64()),
                pa.array(set_keys, pa.binary()), _lists(bands), _lists(sketches),
            ],
            names=["row", "doc_id", "text_hash", "n_shingles", "set_key", "bands", "sketch"],
        )


def _set_key(found: np.ndarray) -> bytes:
    import xxhash

    return xxhash.xxh3_128_digest(found.tobytes())


def _lists(arrays: list[np.ndarray]) -> pa.ListArray:
    offsets = np.cumsum([0, *map(len, arrays)]).astype(np.int32)
    values = np.concatenate(arrays) if arrays else np.empty(0, dtype=np.int64)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values.astype(np.int64, copy=False)))


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "text", 1 << 20):
        found = [shingle_set(w).view(np.int64) for w in word_hashes(utf8(batch.column("text")))]
        yield pa.RecordBatch.from_arrays([batch.column("node"), _lists(found)], names=["node", "shingles"])


def _differing_bits(a: str, b: str) -> Column:
    return sum((F.bit_count(F.col(a)[i].bitwiseXOR(F.col(b)[i])) for i in range(SKETCH_BITS // 64)), F.lit(0))


def _may_link(percent: int) -> Column:
    """Sizes allow the similarity, and the odd sketches don't rule it out."""
    small, large = F.least("n", "other_n"), F.greatest("n", "other_n")
    return (small * 100 >= large * percent) & (_differing_bits("sketch", "other_sketch") <= most_odd_bits(percent))


def _rest(left_over: np.ndarray, size: int) -> np.ndarray:
    """A node's shingles that the compared one lacks, as a bitmap by their hashes; its width depends on the compared set's ``size`` alone."""
    width = 1 << max(6, (2 * size - 1).bit_length())
    bits = np.zeros(width, dtype=bool)
    bits[(left_over & U64(width - 1)).astype(np.int64)] = True
    return np.packbits(bits).view(np.int64)


def _compared(percent: int):
    """Pairs of full sets: how many shingles they share, whether that makes a link, and bitmaps: which of ``other``'s the node has, and ``rest``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            shared, linked, bits, rest = [], [], [], []
            for i in range(batch.num_rows):
                a = batch.column("shingles")[i].values.to_numpy().view(U64)
                b = batch.column("other_shingles")[i].values.to_numpy().view(U64)
                at = np.searchsorted(a, b)
                both = a[np.minimum(at, len(a) - 1)] == b
                count = int(both.sum())
                shared.append(count)
                linked.append(100 * count >= percent * (len(a) + len(b) - count))
                raw = np.packbits(both)
                bits.append(np.append(raw, np.zeros(-len(raw) % 8, np.uint8)).view(np.int64))
                rest.append(_rest(np.delete(a, at[both]), len(b)))
            yield pa.RecordBatch.from_arrays(
                [batch.column("node"), batch.column("other"), pa.array(shared, pa.int64()), pa.array(linked, pa.bool_()), _lists(bits), _lists(rest)],
                names=["node", "other", "shared", "linked", "bits", "rest"])

    return run


def _confirmed(pairs: DataFrame, nodes: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """The pairs (``node``, ``other``) compared on their full shingle sets."""
    wanted = pairs.select(F.explode(F.array("node", "other")).alias("node")).distinct()
    located = store_and_release(nodes.join(wanted, "node").select("node", "doc_key", "text_hash"), "located")
    found = keep_listed(texts, located, ["doc_key", "text_hash"])
    sets = store_and_release(
        found.join(located, ["doc_key", "text_hash"]).dropDuplicates(["node"]).select("node", "text")
        .mapInArrow(_sets, "node long, shingles array<long>"),
        "sets",
    )
    other = sets.select(F.col("node").alias("other"), F.col("shingles").alias("other_shingles"))
    both = pairs.join(sets, "node").join(other, "other").select("node", "other", "shingles", "other_shingles")
    return both.mapInArrow(_compared(percent), "node long, other long, shared long, linked boolean, bits array<long>, rest array<long>")


def _links(compared: DataFrame) -> DataFrame:
    return compared.where("linked").select(F.col("node").alias("u"), F.col("other").alias("v"))


def _first_meeting() -> Column:
    """Whether ``bucket`` is the first that both nodes are in, so that a pair leaves the join once."""
    shared = F.filter(F.zip_with("bands", "other_bands", lambda a, b: F.when(a == b, a)), lambda key: key.isNotNull())
    return F.get(shared, 0) == F.col("bucket")


def _in_both(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: F.bit_count(x.bitwiseAND(y))), F.lit(0), lambda total, n: total + n)


def _reachable(percent: int) -> Column:
    """Whether a pair can still be a link, after both were compared with the same further nodes.

    They share what both have of such a node's shingles, exactly, and of the rest
    at most the hashes in both bitmaps, and for one of the two the shingles that
    share a hash with another one.
    """
    def ruled_out(a: Column, b: Column) -> Column:
        most = _in_both(a["bits"], b["bits"]) + _in_both(a["rest"], b["rest"]) + F.least(a["doubled"], b["doubled"])
        return (a["pivot"] == b["pivot"]) & (most * (100 + percent) < (F.col("n") + F.col("other_n")) * percent)

    return ~F.coalesce(F.exists("seen", lambda a: F.exists("other_seen", lambda b: ruled_out(a, b))), F.lit(False))


def _comparisons(compared: DataFrame, nodes: DataFrame) -> DataFrame:
    """``node``, ``pivot`` and what is known of the two: shared shingles, the rest, and how many of it share their hash."""
    used = F.aggregate("rest", F.lit(0), lambda total, word: total + F.bit_count(word))
    sizes = compared.join(nodes.select("node", "n"), "node")
    return sizes.select("node", F.struct(F.col("other").alias("pivot"), "bits", "rest", (F.col("n") - F.col("shared") - used).alias("doubled")).alias("one"))


def _placed(entries: DataFrame, parts: DataFrame) -> DataFrame:
    """Nodes of the buckets with their components so far."""
    return entries.select("bucket", "node").join(parts, "node", "left").withColumn("component", F.coalesce("component", "node"))


def _open_buckets(placed: DataFrame) -> DataFrame:
    """Buckets of several components: ``total`` nodes and ``most``, the largest component with its size."""
    sizes = placed.groupBy("bucket", "component").agg(F.count(F.lit(1)).alias("size"))
    return sizes.groupBy("bucket").agg(
        F.max(F.struct("size", "component")).alias("most"), F.sum("size").alias("total"), F.count(F.lit(1)).alias("parts")).where("parts > 1")


def _arranged(entries: DataFrame, parts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``_placed`` and ``_open_buckets``, stored: the next round reads them several times."""
    placed = store_and_release(_placed(entries, parts), "placed")
    return placed, store_and_release(_open_buckets(placed), "totals")


def _next_stars(placed: DataFrame, totals: DataFrame, used: DataFrame, light: DataFrame, renamed: DataFrame, percent: int) -> DataFrame:
    """For each node of an open bucket one more node to compare it with: ``node``, ``other``.

    A bucket's new pivot is its node with the most company over all buckets (what
    copies were made from meets the most of them) that was none before. A node that
    has several gets the one with the most company.
    """
    inside = placed.join(totals.select("bucket", "total"), "bucket")
    company = inside.groupBy("node").agg(F.sum("total").alias("company")).join(used, "node", "left_anti")
    pivots = inside.join(company, "node").groupBy("bucket").agg(F.max(F.struct("company", "node", "component")).alias("chosen"))
    pairs = placed.join(pivots, "bucket").where("component <> chosen.component").select(
        "node", F.col("chosen.node").alias("other"), "chosen.company").distinct()
    pairs = pairs.join(light, "node").join(renamed, "other").where(_may_link(percent))
    return pairs.groupBy("node").agg(F.max(F.struct("company", "other")).alias("best")).select("node", "best.other")


def near_duplicates(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """Groups of near-duplicate documents; one row per input row.

    ``docs`` has ``doc_id`` and ``text``; other columns are ignored. Returns
    ``doc_id``, ``text_hash`` (of the row's text, to find the row again),
    ``n_shingles`` (size of the set), ``component_id`` (smallest ``doc_id``
    reachable over links), ``kept``.

    Method. MinHash samples are cut into bands; rows with equal sets become one
    node first, so copies cost nothing later. Each node is compared on the full
    sets with the earliest of its buckets' (band keys') first nodes that sizes and
    odd sketches allow. If what is left would be many comparisons, further pivots are
    tried, one per node and round. Only buckets that still hold more than one component are
    compared further, and only across components: rows outside the bucket's largest
    component against the bucket. Size, sketch, and, of nodes compared with the same
    third one, what they can share at most are tested inside the join, so that what
    leaves the join is a likely link, to be confirmed as well. Links are
    joined to components on Spark. No group is capped; two linked sets are missed
    only if they meet in no band or the sketch errs by six standard errors.

    Null or empty texts have no shingles, are linked with nothing and keep their
    own ``doc_id``. Rows with a null ``doc_id`` take part; a component of such
    rows only has a null id and keeps its rows. Repeated rows are equal sets.
    An empty table gives no rows.
    """
    keyed = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"),
    ).withColumn("text_hash", F.xxhash64(F.coalesce("text", F.lit(""))))
    rows = store_and_release(keyed.mapInArrow(_signatures, _SIGNATURE), "signatures")
    filled = rows.where("n_shingles > 0")
    texts = keyed.select(F.coalesce("doc_id", F.lit(-(2**63))).alias("doc_key"), "text_hash", "text").where("text IS NOT NULL")

    # One node per distinct set: the smallest of its rows.
    least = F.min(F.struct("row", F.coalesce("doc_id", F.lit(-(2**63))).alias("doc_key"), "text_hash")).alias("least")
    heads = filled.groupBy("set_key").agg(least)
    heads = store_and_release(heads.select("set_key", F.col("least.row").alias("node"), "least.doc_key", "least.text_hash"), "heads")
    signed = filled.select(F.col("row").alias("node"), F.col("n_shingles").alias("n"), "bands", "sketch")
    nodes = store_and_release(heads.select("node", "doc_key", "text_hash").join(signed, "node"), "nodes")

    # The earliest document of a bucket is its pivot: what the others were copied from, if it is there.
    entries = nodes.select("node", "doc_key", F.explode("bands").alias("bucket"))
    shared = entries.groupBy("bucket").agg(F.min(F.struct("doc_key", "node")).alias("pivot"), F.count(F.lit(1)).alias("size")).where("size > 1")
    entries = store_and_release(entries.drop("doc_key").join(shared.drop("size"), "bucket"), "entries")

    light = nodes.select("node", "n", "sketch")
    renamed = light.toDF("other", "other_n", "other_sketch")
    stars = entries.where("node <> pivot.node").select("node", F.col("pivot.node").alias("other"), "pivot.doc_key").distinct()
    stars = stars.join(light, "node").join(renamed, "other").where(_may_link(percent))
    stars = store_and_release(stars.groupBy("node").agg(F.min(F.struct("doc_key", "other")).alias("least")).select("node", "least.other"), "pairs")
    compared = store_and_release(_confirmed(stars, nodes, texts, percent), "confirmed")
    links = _links(compared)
    parts = store_and_release(connected_components(links), "parts")

    # Where copies are unlike their pivot, further pivots keep the comparisons of the next step in proportion to the nodes.
    seen = _comparisons(compared, nodes)
    used = entries.select("pivot.node").distinct()
    node_count = nodes.count()
    placed, totals = _arranged(entries, parts)
    for _ in range(MORE_PIVOTS):
        if (totals.agg(F.sum((F.col("total") - F.col("most.size")) * F.col("total"))).first()[0] or 0) <= PAIRS_PER_NODE * node_count:
            break
        stars = store_and_release(_next_stars(placed, totals, used, light, renamed, percent), "pairs")
        if stars.isEmpty():
            break
        again = store_and_release(_confirmed(stars.select("node", "other"), nodes, texts, percent), "confirmed")
        links = links.unionByName(_links(again))
        parts = store_and_release(connected_components(links), "parts")
        seen = seen.unionByName(_comparisons(again, nodes))
        used = store_and_release(used.unionByName(stars.select(F.col("other").alias("node"))).distinct(), "used")
        tried = again.agg(F.count(F.lit(1)).alias("pairs"), F.count_if("linked").alias("linked")).first()
        placed, totals = _arranged(entries, parts)
        if tried["linked"] < LEAST_LINKED * tried["pairs"]:
            break

    # Buckets that hold several components still may hide links between them.
    open_buckets = totals.select("bucket", F.col("most.component").alias("major"))
    # One comparison a round at most.
    seen = seen.groupBy("node").agg(F.collect_list("one").alias("seen"))
    members = store_and_release(placed.join(open_buckets, "bucket").join(nodes.select("node", "n", "sketch", "bands"), "node").join(seen, "node", "left"), "members")
    minor = members.where("component <> major").drop("major")
    twins = ("component", "n", "sketch", "bands", "seen")
    others = members.select("bucket", "major", F.col("node").alias("other"), *(F.col(c).alias(f"other_{c}") for c in twins))
    once = (F.col("other_component") == F.col("major")) | (F.col("node") < F.col("other"))
    untried = ~F.coalesce(F.exists("seen", lambda a: a["pivot"] == F.col("other")) | F.exists("other_seen", lambda b: b["pivot"] == F.col("node")), F.lit(False))
    apart = (F.col("component") != F.col("other_component")) & once & untried
    across = minor.join(others, "bucket").where(apart & _first_meeting() & _may_link(percent) & _reachable(percent))
    across = store_and_release(across.select(F.least("node", "other").alias("node"), F.greatest("node", "other").alias("other")).distinct(), "pairs")
    if not across.isEmpty():
        more = store_and_release(_confirmed(across, nodes, texts, percent), "confirmed")
        parts = store_and_release(connected_components(links.unionByName(_links(more))), "parts")

    member = (
        rows.select("row", "doc_id", "text_hash", "n_shingles", "set_key").join(heads.select("set_key", "node"), "set_key", "left")
        .join(parts, "node", "left")
        .select("doc_id", "text_hash", "n_shingles", F.coalesce("component", "node", "row").alias("component"))
    )
    ids = member.where("n_shingles > 0").groupBy("component").agg(F.min("doc_id").alias("least_id"))
    joined = member.join(ids, "component", "left")
    component = F.when(F.col("n_shingles") > 0, F.col("least_id")).otherwise(F.col("doc_id"))
    return joined.select(
        "doc_id", "text_hash", "n_shingles", component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept"), "component",
    )


def keep_one(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The rows of ``docs`` that remain when one document of each near-duplicate group stays, all columns, whatever their names.

    The smallest ``doc_id`` stays, among its rows the one of the smallest text
    hash. Documents without words stay; their exact repeats (id and text, a null one
    counts as empty) go. Of rows with one id and one text one stays, whatever else
    they hold. An empty table gives no rows.
    """
    found = near_duplicates(docs, percent)
    no_words = F.col("n_shingles") == 0
    grouped = found.where(~no_words).groupBy("component").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash")).alias("least"))
    stay = store_and_release(
        grouped.select("least.doc_id", "least.text_hash")
        .unionByName(found.where(no_words).select("doc_id", "text_hash").distinct()),
        "stay",
    ).select(F.col("doc_id").alias("kept_id"), F.col("text_hash").alias("kept_hash"))
    hashed = docs.select(
        F.struct("*").alias("row"), F.col("doc_id").cast("long").alias("id"), F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit(""))).alias("hash"))
    on = hashed["id"].eqNullSafe(stay["kept_id"]) & (hashed["hash"] == stay["kept_hash"])
    return hashed.join(stay, on, "left_semi").dropDuplicates(["id", "hash"]).select(*[F.col("row")[c].alias(c) for c in docs.columns])
