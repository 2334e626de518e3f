"""Operators 11 to 13 against brute-force versions, their SQL, and the tokenizers library."""

import collections
import hashlib
import itertools
import os
import random
import re
import zlib

import duckdb
import numpy as np
import pytest

public_tokenizers = pytest.importorskip("public_tokenizers")

from reelmetry.llm import pfor, queries, sql, token_files, token_ids, turn_repair, word_variants  # noqa: E402

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables are not here")
WORDS = public_tokenizers.path("word_bpe_49k.json")

#: Null and empty texts, a null id, equal rows, equal ids with other texts, special strings; clashing extra columns.
EDGE = [
    (1, None), (2, ""), (3, " \n\t "), (4, "One two three."), (4, "One two three."), (4, "another"), (None, "no id <|endoftext|> here"), (-6, "日本 é é İx don't 'LL %%%'s x×y"),
    (7, "word!? " * 9000), (8, "x" * 70000), (9, "a\x00b  c\n\nd"), (2**62, "Straße ÀÉÎ&&& ﬁ"),
]


@pytest.fixture(scope="module")
def edge(spark):
    return spark.createDataFrame([(i, t, 1, "p", t) for i, t in EDGE], "doc_id long, text string, part int, value string, word string")


def duck(query, **tables):
    con = duckdb.connect()
    for name, df in tables.items():
        con.register(name, df.toArrow())
    found = con.execute(query)
    names = [d[0] for d in found.description]
    return sorted((dict(zip(names, r, strict=True)) for r in found.fetchall()), key=repr)


def as_dicts(df, like):
    return sorted(({k: r[k] for k in like} for r in df.collect()), key=repr)


# Word ids and block codes ---------------------------------------------

def library_ids(texts):
    from tokenizers import Tokenizer

    model = Tokenizer.from_file(WORDS)
    model.no_truncation()
    return [list(e.ids) for e in model.encode_batch(texts, add_special_tokens=False)]


def test_word_ids_of_odd_strings(monkeypatch):
    monkeypatch.setattr(token_ids, "BLOCK", 200)
    monkeypatch.setattr(token_ids, "REMEMBERED", 40)
    rng, coder = random.Random(5), token_ids.WordIds(WORDS)
    parts = ["a", "Be", " ", "\n", "\t", "é", "é", "É", "×", "÷", "İ", "日", "'s", "'", "'LL", "!", "%%%", "≠", "<|endoftext|>", "<|", "|>", "12", "\xa0", "thing.", "x_y", "🎉"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 120))) for _ in range(600)] + [t or "" for _, t in EDGE]
    for at in range(0, len(texts), 50):
        some = texts[at : at + 50]
        assert [np.frombuffer(b, dtype=coder.dtype).tolist() for b in coder.encode_many(some)] == library_ids(some)


@pytest.mark.parametrize("count", [0, 1, 127, 128, 129, 5000])
def test_block_codes(count):
    rng = np.random.default_rng(count)
    for high in (1, 2, 49_408, 1 << 40):
        values = rng.integers(0, high, count)
        if count > 9:
            values[rng.integers(0, count, count // 20 + 1)] = rng.integers(-(1 << 62), 1 << 62, count // 20 + 1)
        data = b"xyz" + pfor.encode(values) + b"rest"
        assert pfor.encoded_size(data, 3) == len(data) - 7
        assert (pfor.decode(data, 3) == values).all()
        for start, stop in ((0, 1), (100, 300), (127, 129), (count - 1, count + 5), (7, 3)):
            assert (pfor.decode(data, 3, start, stop) == values[max(start, 0) : max(stop, 0)]).all()


def test_block_codes_of_extremes_and_outliers():
    values = np.array([-(1 << 63), (1 << 63) - 1, 0, 5] * 64)
    assert (pfor.decode(pfor.encode(values)) == values).all()
    few = np.full(128 * 100, 3)
    few[::40] = 40_000  # three or four of a block's 128: exceptions, not a wider block
    assert len(pfor.encode(few)) < 128 * 100 * 0.3


def test_crc_of_joined_strings():
    rng = random.Random(1)
    for size in (0, 1, 7, 1000, 65_536):
        a, b = rng.randbytes(50), rng.randbytes(size)
        assert token_files.crc_joined(zlib.crc32(a), zlib.crc32(b), size) == zlib.crc32(a + b)


# 11 -----------------------------------------------------------------

def brute_files(rows, end_id=1):
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))
    out, at = [], 0
    for (doc_id, _), ids in zip(rows, library_ids([t or "" for _, t in rows]), strict=True):
        ids = [*ids, end_id]
        out.append((doc_id, at, len(ids), zlib.crc32(np.array(ids, dtype="<u4").tobytes()), ids))
        at += len(ids)
    return out


def in_files(df):
    return [(r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in df.orderBy("start").collect()]


def test_token_files(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    assert in_files(queries.queries()["op11_patched_frames"](spark, SF)) == [r[:4] for r in brute_files(rows)]


@pytest.mark.parametrize(("frame_ids", "file_frames"), [(1 << 18, 64), (100, 3), (7, 1)])
def test_token_files_edges(spark, edge, monkeypatch, tmp_path, frame_ids, file_frames):
    monkeypatch.setattr(token_files, "FRAME_IDS", frame_ids)
    monkeypatch.setattr(token_files, "FILE_FRAMES", file_frames)
    folder = str(tmp_path / "ids")
    docs = edge if frame_ids > 7 else edge.where("length(text) < 1000 OR text IS NULL")
    token_files.write_ids(docs, folder, WORDS)
    got = token_files.read_ids(spark, folder, with_ids=True).orderBy("start").collect()
    rows = [(i, t) for i, t in EDGE if frame_ids > 7 or len(t or "") < 1000]
    expected = brute_files(rows)
    assert sorted((r.doc_id is None, r.doc_id, r.n_tokens, r.ids_crc32) for r in got) == sorted((d is None, d, n, c) for d, _, n, c, _ in expected)
    assert [r.doc_id for r in got] == [d for d, *_ in expected]
    assert [r.start for r in got] == [0, *itertools.accumulate(r.n_tokens for r in got)][:-1]
    assert all(zlib.crc32(r.ids) == r.ids_crc32 and len(r.ids) == 4 * r.n_tokens for r in got)
    files = sorted(f for f in os.listdir(folder) if f.startswith("part-"))
    data = (tmp_path / "ids" / files[-1]).read_bytes()
    first = next(token_files.frames(data))
    assert first.ids(2, 5).tolist() == first.ids()[2:5].tolist() and first.count <= frame_ids
    with pytest.raises(ValueError, match="frame"):
        list(token_files.frames(data[1:]))


def test_token_files_of_nothing(spark, edge):
    assert token_files.round_trip(edge.limit(0), WORDS).collect() == []


# 12 -----------------------------------------------------------------

def exhaustive_edits(codes):
    """All edits with at most two inserts in a row: the least cost, then the least audit."""
    best = None
    on = {0: 2, 1: 2, 2: 3, 3: 2}
    keeps = {(0, 0): 1, (0, 1): 2, (1, 1): 2, (2, 2): 3, (3, 1): 2}

    def walk(i, state, cost, audit, inserts):
        nonlocal best
        if best and cost > best[0]:
            return
        if i == len(codes) and state in (0, 3):
            best = min(best or (cost, audit), (cost, audit))
        if inserts < 2:
            walk(i, on[state], cost + 2, audit + "I", inserts + 1)
        if i < len(codes):
            initial, fault = divmod(codes[i], 3)
            walk(i + 1, state, cost + 3, audit + "D", 0)
            if fault < 2:
                walk(i + 1, on[state], cost + 2 + fault, audit + "R", 0)
                if (state, initial) in keeps:
                    walk(i + 1, keeps[state, initial], cost + fault, audit + "K", 0)

    walk(0, 0, 0, "", 0)
    return best


def test_edits_equal_all_edits():
    rng = random.Random(2)
    for size in range(7):
        for _ in range(40):
            codes = bytes(rng.randrange(12) for _ in range(size))
            assert turn_repair.cheapest_edits(codes) == exhaustive_edits(codes), list(codes)


def test_long_conversations_are_solved_as_short_ones():
    """Whole, or in stretches with costs in between, the edits are those of a plain walk with the least (cost, audit) per state."""
    rng = random.Random(4)
    codes = bytes(rng.randrange(12) for _ in range(700))
    best = {0: (0, "")}
    for c in codes:
        after = {}
        for p, (cost, audit) in best.items():
            for q, (more, letters) in enumerate(turn_repair.STEPS[c][p]):
                if letters:
                    after[q] = min(after.get(q, (1 << 62, "")), (cost + more, audit + letters))
        best = after
    plain = min((cost + turn_repair.END_COSTS[q], audit + "I" * (turn_repair.END_COSTS[q] // 2)) for q, (cost, audit) in best.items())
    assert turn_repair.cheapest_edits(codes) == plain


def test_conversations_equal_sql(spark):
    got = queries.queries()["op12_hirschberg_repair"](spark, SF)
    expected = duck(queries.oracle_sql()["op12_hirschberg_repair"], conversations=spark.read.parquet(f"{SF}/conversations.parquet"))
    assert expected and as_dicts(got, expected[0]) == expected


def odd_conversations():
    rng = random.Random(3)
    roles, said = ["user", "assistant", "system", "tool", "", None, "uncle"], ["Hi.", "ok", "  ", None, "What?", "x!  ", "a.b", "\x1f", "é…"]
    rows = [(10**6, None if i % 50 == 0 else i // 2, rng.choice(roles), rng.choice(said)) for i in range(1500)]
    rows += [(c, t, rng.choice(roles[:4]), f"{rng.random()}.") for c in range(40) for t in range(rng.randint(1, 9))]
    rows += [(None, 1, "user", "x."), (None, 2, "assistant", "x."), (None, 2, "assistant", "x."), (-5, None, None, None), (-6, 3, "", "")]
    return rows


def test_odd_conversations(spark):
    """Nulls, ties, repeated rows, other roles, and a conversation that spans all tasks."""
    schema = "conv_id long, turn long, role string, text string"
    plain = spark.createDataFrame(odd_conversations(), schema)
    expected = duck(sql.turn_repair_sql(), conversations=plain)
    clashing = spark.createDataFrame([(*r, "k", "d", 0) for r in odd_conversations()], schema + ", key string, digest string, part int")
    got = turn_repair.repair(turn_repair.damaged(clashing))
    names = list(expected[0])
    assert len(expected) == len({r["conv_id"] for r in expected}) == got.count()
    assert as_dicts(got, names) == expected
    assert turn_repair.repair(turn_repair.damaged(plain.limit(0))).collect() == []


def test_sound_conversations_stay(spark):
    rows = [(1, 0, "system", "Be kind."), (1, 1, "user", "Hi?"), (1, 2, "assistant", "Hello."), (2, 5, "user", "Why?"), (2, 7, "user", "Well?")]
    got = {r.conv_id: r for r in turn_repair.repair(spark.createDataFrame(rows, "conv_id int, turn int, role string, text string")).collect()}
    assert (got[1].cost, got[1].audit, got[1].gaps) == (0, "KKK", 0)
    assert got[1].repaired_sha256 == hashlib.sha256(b"system:Be kind.\nuser:Hi?\nassistant:Hello.").hexdigest()
    assert (got[2].cost, got[2].audit, got[2].gaps, got[2].illegal) == (2, "KR", 1, 1)


# 13 -----------------------------------------------------------------

def brute_variants(rows):
    found = collections.Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 199 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            found[run] += 1
    n = {w: c for w, c in found.items() if len(w) >= 6 and c >= 5}
    letters = {c for w in n for c in w}
    near = {}
    for w in n:
        ways = {w[:i] + w[i + 1 :] for i in range(len(w))}
        ways |= {w[:i] + c + w[j:] for i in range(len(w) + 1) for c in letters for j in (i, i + 1)}
        near[w] = [v for v in ways if v != w and v in n and abs(len(v) - len(w)) < 2]
    form = {w: min(near[w], key=lambda v: (-n[v], v), default=None) for w in n}
    form = {w: f if f and n[f] >= 5 * n[w] else None for w, f in form.items()}

    def root(w):
        return root(form[w]) if form[w] else w

    return {w: (w, form[w], root(w), n[w], len(near[w]), n[form[w]] if form[w] else None) for w in n}


CHAINS = [
    (None, "Straße ÀÉÎÕÜ× abcdefg÷ " * 9), (9, None), (8, ""), (7, "abcdef " * 125 + "abcdefg " * 25 + "abcdefgh " * 5 + "abcdefgi " * 5 + "abcdefgj " * 25),
    (7, "abcdef " * 3), (6, "ZÉZÉZÉ " * 30 + "zÉzÉz " * 9 + "zÉzÉzé " * 6 + "xyzxyz " * 40), (5, "q" * 50_000 + " " + "q" * 49_999),
]


@pytest.mark.parametrize(("part_words", "part_queries"), [(20_000, 100_000), (40, 60), (3, 5)])
def test_variants_equal_brute_force(spark, monkeypatch, part_words, part_queries):
    monkeypatch.setattr(word_variants, "PART_WORDS", part_words)
    monkeypatch.setattr(word_variants, "PART_QUERIES", part_queries)
    monkeypatch.setattr(word_variants, "PIECE", 1000)
    monkeypatch.setattr(word_variants, "COUNTED", 500)
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    rows = [(r.doc_id, r.text) for r in (docs.limit(40) if part_words < 10 else docs).collect()] + CHAINS
    df = spark.createDataFrame([(*r, "w", 1, "x") for r in rows], "doc_id long, text string, word string, n int, path string")
    got = {r.word: tuple(r) for r in word_variants.group_variants(df).collect()}
    assert got == brute_variants(rows)
    assert got["abcdefgh"][:3] == ("abcdefgh", "abcdefg", "abcdef")


def test_variants_equal_sql(spark):
    got = queries.queries()["op13_spelling_variants"](spark, SF)
    expected = duck(queries.oracle_sql()["op13_spelling_variants"], documents=spark.read.parquet(f"{SF}/documents.parquet"))
    names = list(expected[0])
    assert expected and as_dicts(got, names) == expected


def test_variants_of_nothing(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert word_variants.group_variants(empty).collect() == []
    assert word_variants.group_variants(spark.createDataFrame([(1, "short words only")], "doc_id long, text string")).collect() == []


def test_one_edit():
    words = ["", "a", "b", "ab", "ba", "abc", "acb", "abcd", "abxd", "xabc", "abcx", "aabb", "abab", "éa", "ea"]

    def distance(a, b):
        if not a or not b:
            return len(a) + len(b)
        return min(distance(a[1:], b) + 1, distance(a, b[1:]) + 1, distance(a[1:], b[1:]) + (a[0] != b[0]))

    for a, b in itertools.product(words, words):
        assert word_variants.one_edit(a, b) == (distance(a, b) == 1), (a, b)
