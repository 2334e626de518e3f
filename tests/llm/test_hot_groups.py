"""Work that must not grow with the square of a group of near copies, or of a word."""

import platform
import random

import numpy as np
import pytest

public_tokenizers = pytest.importorskip("public_tokenizers")

from reelmetry.llm import nnls_packing, odd_dedup, piece_bpe, secret_markov, token_ids  # noqa: E402
from reelmetry.llm.queries import WORDS, tokenizer_path  # noqa: E402
from reelmetry.operators import skew  # noqa: E402


def unlike_copies(count, words=150, changed=8):
    """Copies of one text, each with a few words changed: unlike one another, but not by sketch or size. The last two differ in one word."""
    rng = random.Random(9)
    base = [f"w{i}" for i in range(words)]
    out = []
    for _ in range(count):
        w = list(base)
        for at in rng.sample(range(words), changed):
            w[at] = f"x{rng.randrange(10**9)}"
        out.append(w)
    out.append([*out[-1][:-1], "other"])
    return [(i, " ".join(w)) for i, w in enumerate(out, 1)]


def shingles(text):
    w = text.split()
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)}


def test_near_copies_below_the_threshold_are_not_compared_with_each_other(spark, monkeypatch):
    rows = unlike_copies(150)
    compared, confirmed = [], odd_dedup._confirmed

    def counted(pairs, *rest):
        compared.append(pairs.count())
        return confirmed(pairs, *rest)

    monkeypatch.setattr(odd_dedup, "_confirmed", counted)
    found = {r.doc_id: r.component_id for r in odd_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    sets = {i: shingles(t) for i, t in rows}
    links = [(a, b) for a in sets for b in sets if a < b and 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b])]
    assert links == [(150, 151)]
    assert found == {i: min(i, 150) for i in sets}
    assert sum(compared) < 10 * len(rows)


def test_the_rest_of_two_sets_is_bounded_from_above(spark):
    """Whatever hashes meet, the bound is no less than what is shared."""
    import numpy as np
    import pyarrow as pa

    rng = np.random.default_rng(3)
    compare = odd_dedup._compared(85)
    for size in (1, 3, 40, 300):
        pivot, common = (np.unique(rng.integers(0, 2**63, size).astype(np.uint64)) for _ in range(2))
        sides = []
        for _ in range(2):
            a = np.unique(np.concatenate([rng.choice(pivot, size // 2, replace=False), common, rng.integers(0, 2**63, size).astype(np.uint64)]))
            batch = pa.RecordBatch.from_arrays(
                [pa.array([1]), pa.array([2]), odd_dedup._lists([a.view(np.int64)]), odd_dedup._lists([pivot.view(np.int64)])],
                names=["node", "other", "shingles", "other_shingles"])
            row = next(iter(compare(iter([batch])))).to_pylist()[0]
            assert row["shared"] == len(np.intersect1d(a, pivot))
            words = [w & (2**64 - 1) for w in row["rest"]]
            sides.append((a, [w & (2**64 - 1) for w in row["bits"]], words, len(a) - row["shared"] - sum(map(int.bit_count, words))))
        (a, a_bits, a_rest, a_twice), (b, b_bits, b_rest, b_twice) = sides

        def both(x, y):
            return sum((i & j).bit_count() for i, j in zip(x, y, strict=True))

        in_pivot = len(np.intersect1d(np.intersect1d(a, b), pivot))
        assert both(a_bits, b_bits) == in_pivot
        assert both(a_rest, b_rest) + min(a_twice, b_twice) >= len(np.intersect1d(a, b)) - in_pivot


def test_merging_ranks_only_new_neighbours():
    coder = piece_bpe.encoder(public_tokenizers.path("piece_bpe_32k.model"))

    class Counted(dict):
        asked = 0

        def get(self, *args):
            Counted.asked += 1
            return super().get(*args)

    def plainly(text):
        parts = list(text)
        while True:
            ranks = [(coder.rank.get(a + b, float("inf")), i) for i, (a, b) in enumerate(zip(parts, parts[1:]))]
            best, at = min(ranks, default=(float("inf"), 0))
            if best == float("inf"):
                return parts
            parts[at : at + 2] = [parts[at] + parts[at + 1]]

    words = ["", "a", "internationalization", "aaaaaaaaaaaa", "▁the▁", "schschenstach", "".join(random.Random(2).choices("abcdenrst", k=80))]
    assert [coder.merged(w) for w in words] == [plainly(w) for w in words]
    rank, coder.rank = coder.rank, Counted(coder.rank)
    try:
        coder.merged("internationalization" * 4)
        assert Counted.asked <= 3 * 80
    finally:
        coder.rank = rank


def full_collections(spark):
    beans = spark._jvm.java.lang.management.ManagementFactory.getGarbageCollectorMXBeans()
    return sum(bean.getCollectionCount() for bean in beans if "Young" not in bean.getName() and "Scavenge" not in bean.getName())


def test_the_driver_is_released_after_every_stored_table(spark, monkeypatch):
    stored, store = [], skew.store

    def counted(df, name):
        stored.append(name)
        return store(df, name)

    monkeypatch.setattr(skew, "store", counted)
    before = full_collections(spark)
    kept = odd_dedup.keep_one(spark.createDataFrame(unlike_copies(20), "doc_id long, text string"))
    assert {"signatures", "confirmed", "links", "stay"} <= set(stored)
    assert full_collections(spark) - before >= len(stored)
    assert kept.count() == 20


def test_secrets_release_the_driver_after_every_stored_table(spark, monkeypatch):
    stored, store = [], skew.store

    def counted(df, name):
        stored.append(name)
        return store(df, name)

    monkeypatch.setattr(skew, "store", counted)
    strings = [("plain/words/in/a/path", False), ("another-ordinary-name", False), ("short", False), ("9f86d081884c7d659a2feaa0c55ad015", True)]
    before = full_collections(spark)
    secret_markov.train(spark.createDataFrame(strings, "token string, random boolean"))
    # Both medians read one stored table of ratios.
    assert stored == ["strings", "ordinary", "ratios"]
    assert full_collections(spark) - before >= len(stored)


def test_packing_leaves_the_tokenizer_to_the_tasks(spark):
    path = tokenizer_path(WORDS)
    token_ids.word_ids.cache_clear()
    docs = spark.createDataFrame([(1, "some words"), (2, None), (3, "more " * 3000)], "doc_id long, text string")
    pieces = nnls_packing.pack(docs, path, with_ids=True).collect()
    assert token_ids.word_ids.cache_info().currsize == 0
    coder = token_ids.word_ids(path)
    for doc_id, text in ((1, "some words"), (2, ""), (3, "more " * 3000)):
        own = sorted((r for r in pieces if r.doc_id == doc_id), key=lambda r: r.start)
        assert b"".join(bytes(r.ids) for r in own) == coder.encode_many([text])[0] + np.array([1], dtype=coder.dtype).tobytes()
    token_ids.word_ids.cache_clear()


def test_freed_native_memory_is_returned(spark, monkeypatch):
    known = platform.libc_ver()[0] == "glibc" and spark._jvm.java.lang.Runtime.version().feature() >= 17
    reports, trim = [], skew.trim_native_heap
    monkeypatch.setattr(skew, "trim_native_heap", lambda spark: reports.append(trim(spark)))
    skew.release(spark)
    assert len(reports) == 1 and reports[0].startswith("Trim native heap") == known
