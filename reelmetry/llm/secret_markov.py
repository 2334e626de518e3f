"""Secrets in texts: patterns, and character Markov models of random strings against ordinary ones."""

from __future__ import annotations

import json
import math
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelmetry.operators.skew import store_and_release

# The kinds, in the order of their listing, and what they match. A run of capitals and digits, or of hex
# digits, has one leftmost match to its end, so their least lengths can stand in the pattern; an assignment's can't,
# because a match that is too short uses up its text.
KINDS = ("assign", "access", "hex")
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"(?<![0-9a-f])[0-9a-f]{24,}"
LEAST_VALUE = 6
#: The kind of the spans that the models add.
ADDED = "random"

#: Characters of identifiers; what the models judge is every stretch of a run of at least LEAST_RUN of them.
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_-"
LEAST_RUN = 16
RUN = rf"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{{{LEAST_RUN},}}"
#: Least length of a likely stretch, so that two or three odd letters in a word don't make one; and the rest of a run that
#: is taken with it, as a few letters of a random string may look ordinary.
LEAST_STRETCH, LEAST_REST = 10, 6
#: What joins words in paths and slugs; a stretch reaches to the nearest, if that is fewer than LEAST_RUN characters off.
JOINS = "/_-"

#: Bounds of the labelled samples: documents whose words are ordinary, strings of each random kind.
SAMPLE_DOCUMENTS, SAMPLE_STRINGS = 1_000, 4_000
#: Least log-likelihood ratio of a span, and how many deviations (1.4826 x the median one) above the ordinary median it must be.
LEAST_RATIO, DEVIATIONS = 12.0, 6.0


def _text(c: str = "text") -> Column:
    return F.coalesce(F.col(c).cast("string"), F.lit(""))


def matches_with_places(text: Column, pattern: str, kind: int) -> Column:
    """All leftmost non-overlapping matches: array of (start, kind, end, value), code points, end exclusive.

    The pieces that the pattern splits the text into give the places.
    """
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    kinds = "array<struct<start:long,kind:int,end:long,value:string>>"
    gaps = F.slice(F.split(text, pattern, -1), F.lit(1), F.size(found))
    start = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast(kinds).alias("out"))

    def step(acc: Column, pair: Column) -> Column:
        begin = acc["at"] + F.length(pair["gap"])
        end = begin + F.length(pair["value"])
        span = F.struct(begin.alias("start"), F.lit(kind).alias("kind"), end.alias("end"), pair["value"].alias("value"))
        return F.struct(end.alias("at"), F.concat(acc["out"], F.array(span)).alias("out"))

    pairs = F.zip_with(gaps, found, lambda g, v: F.struct(g.alias("gap"), v.alias("value")))
    return F.when(F.size(found) > 0, F.aggregate(pairs, start, step)["out"]).otherwise(F.array().cast(kinds))


def base_spans(text: Column) -> Column:
    """The spans of the three patterns, by start, then kind."""
    long_enough = F.filter(matches_with_places(text, ASSIGN, 0), lambda m: F.length(F.regexp_extract(m["value"], ASSIGN, 2)) >= LEAST_VALUE)
    # Most texts have none of an access key's letters; the look for them is a plain search.
    access = F.when(F.contains(text, F.lit("AKIA")), matches_with_places(text, ACCESS, 1)).otherwise(
        F.array().cast("array<struct<start:long,kind:int,end:long,value:string>>"))
    return F.array_sort(F.concat(long_enough, access, matches_with_places(text, HEX, 2)))


def _to_join(inner: Column, outside: Column) -> Column:
    """Characters of ``outside`` to add to ``inner``, or below 0 to drop from it, so that the part at their border is whole.

    ``inner`` starts at the border. A part of which it has the smaller share is dropped, unless it has no other.
    """
    part, joins = F.length(F.regexp_extract(inner, rf"^[^{JOINS}]*", 0)), F.length(F.regexp_extract(inner, rf"^[^{JOINS}]*[{JOINS}]*", 0))
    rest = F.length(F.regexp_extract(outside, rf"^[^{JOINS}]*", 0)) % LEAST_RUN
    return F.when((part == 0) | ((part < rest) & (part < F.length(inner))), -joins).otherwise(rest)


@dataclass
class MarkovPair:
    """Log-likelihood ratios of character transitions (random against ordinary), row by row, and the deciding total.

    State 0 is the start of a string, state i the i-th character of ALPHABET.
    """

    ratios: list[float]
    threshold: float

    def _walked(self, token: Column) -> Column:
        """``out`` (start, end of the stretches that the random model explains far better) and ``most`` (the best one's ratio) of a run.

        A running sum of the ratios starts anew where it isn't positive, or has fallen from its best by the threshold;
        a stretch ends at its best. So neither ordinary text around a secret nor another secret hides it.
        """
        states = len(ALPHABET) + 1
        table = F.from_json(F.lit(json.dumps(self.ratios)), "array<double>")
        none = F.array().cast("array<struct<start:int,end:int>>")
        zero = {"at": 0, "state": 0, "total": 0.0, "start": 0, "best": 0.0, "end": 0, "most": 0.0}
        start = F.struct(*(F.lit(v).alias(k) for k, v in zero.items()), none.alias("out"))

        def closed(acc: Column) -> Column:
            likely = (acc["best"] >= self.threshold) & (acc["end"] - acc["start"] >= LEAST_STRETCH)
            return F.when(likely, F.concat(acc["out"], F.array(F.struct(acc["start"].alias("start"), acc["end"].alias("end"))))).otherwise(acc["out"])

        def step(acc: Column, letter: Column) -> Column:
            state = F.instr(F.lit(ALPHABET), letter)
            over = (acc["total"] <= 0) | (acc["total"] < acc["best"] - self.threshold)
            total = F.when(over, 0.0).otherwise(acc["total"]) + F.get(table, acc["state"] * states + state)
            best = F.when(over, 0.0).otherwise(acc["best"])
            return F.struct(
                (acc["at"] + 1).alias("at"), state.alias("state"), total.alias("total"), F.when(over, acc["at"]).otherwise(acc["start"]).alias("start"),
                F.greatest(best, total).alias("best"), F.when(total > best, acc["at"] + 1).otherwise(acc["end"]).alias("end"),
                F.greatest(acc["most"], total).alias("most"), F.when(over, closed(acc)).otherwise(acc["out"]).alias("out"))

        return F.aggregate(
            F.split(token, ""), start, step, lambda acc: F.struct(closed(acc).alias("out"), acc["most"].alias("most")))

    def ratio(self, token: Column) -> Column:
        """The highest log-likelihood ratio of a stretch of a run of ALPHABET characters."""
        return self._walked(token)["most"]

    def spans(self, text: Column, base: Column) -> Column:
        """Stretches of runs that the random model explains far better, apart from the base spans."""

        def placed(run: Column) -> Column:
            def span(found: Column) -> Column:
                size = F.length(run["value"])
                inner = F.substr(run["value"], found["start"] + 1, found["end"] - found["start"])
                before = F.substr(run["value"], F.greatest(found["start"] - LEAST_RUN, F.lit(0)) + 1, F.least(found["start"], F.lit(LEAST_RUN)))
                after = F.substr(run["value"], found["end"] + 1, F.lit(LEAST_RUN))
                back, ahead = _to_join(inner, F.reverse(before)), _to_join(F.reverse(inner), after)
                fits = found["end"] + ahead > found["start"] - back
                start = F.when(fits, found["start"] - back).otherwise(found["start"])
                end = F.when(fits, found["end"] + ahead).otherwise(found["end"])
                start = F.when(start < LEAST_REST, 0).otherwise(start)
                end = F.when(size - end < LEAST_REST, size).otherwise(end)
                return F.struct(
                    (run["start"] + start).alias("start"), run["kind"].alias("kind"), (run["start"] + end).alias("end"),
                    F.substr(run["value"], start + 1, end - start).alias("value"))

            return F.transform(self._walked(run["value"])["out"], span)

        likely = F.flatten(F.transform(matches_with_places(text, RUN, len(KINDS)), placed))
        return F.filter(likely, lambda m: ~F.exists(base, lambda b: (m["start"] < b["end"]) & (b["start"] < m["end"])))


def _transitions(tokens: DataFrame) -> dict[tuple[int, int], int]:
    """Counts of (state, next state) over a column ``token``; at most 67 * 67 of them."""
    states = F.concat(F.array(F.lit(0)), F.transform(F.split("token", ""), lambda c: F.instr(F.lit(ALPHABET), c)))
    pairs = F.zip_with(F.slice(states, F.lit(1), F.size(states) - 1), F.slice(states, F.lit(2), F.size(states) - 1), lambda a, b: F.struct(a.alias("a"), b.alias("b")))
    counted = tokens.where(F.length("token") > 0).select(F.explode(pairs).alias("p")).groupBy("p.a", "p.b").count().collect()
    return {(r["a"], r["b"]): r["count"] for r in counted}


def labelled_samples(docs: DataFrame, documents: int = SAMPLE_DOCUMENTS, strings: int = SAMPLE_STRINGS) -> DataFrame:
    """``token``, ``random``: bounded labelled samples.

    Ordinary are the identifier runs of at most ``documents`` documents (smallest
    id hashes), their base spans taken out. Random are digests of numbers in hex
    and base64 (``strings`` of each) and the base spans' values in those documents.
    """
    spark = docs.sparkSession
    ids = docs.select("doc_id").distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(documents)
    texts = docs.select("doc_id", _text().alias("text")).join(F.broadcast(ids), "doc_id")
    clean = texts
    for pattern in (ASSIGN, ACCESS, HEX):
        clean = clean.withColumn("text", F.regexp_replace("text", pattern, " "))
    ordinary = clean.select(F.explode(F.regexp_extract_all("text", F.lit("[A-Za-z0-9+/_-]{4,}"), F.lit(0))).alias("token"))
    digest = F.sha2(F.col("id").cast("string"), 256)
    made = spark.range(strings).select(F.explode(F.array(
        F.substring(digest, 1, 32), F.regexp_replace(F.base64(F.unhex(digest)), "=", ""), F.substring(F.upper(F.base64(F.unhex(digest))), 1, 20),
    )).alias("token"))
    matched = texts.select(F.explode(base_spans(F.col("text"))).alias("m")).select(
        F.regexp_extract(F.col("m.value"), r"([A-Za-z0-9+/_-]{12,})[^A-Za-z0-9+/_-]*$", 1).alias("token")).where("token <> ''")
    random = made.unionByName(matched)
    return ordinary.withColumn("random", F.lit(False)).unionByName(random.withColumn("random", F.lit(True)))


def _logs(tokens: DataFrame) -> list[float]:
    """Log-probabilities of the transitions, add-one smoothed, row by row."""
    states = len(ALPHABET) + 1
    counts = _transitions(tokens)
    totals = [sum(counts.get((a, b), 0) for b in range(1, states)) for a in range(states)]
    return [math.log((counts.get((a, b), 0) + 1) / (totals[a] + states - 1)) if b else 0.0 for a in range(states) for b in range(states)]


def train(samples: DataFrame) -> MarkovPair:
    """Both models from labelled strings (``token``, ``random``), add-one smoothed; null tokens count for nothing.

    Ordinary strings may hold secrets that nobody labelled. So a first ordinary
    model sees only the strings too short to be judged; the long ones that look
    random to it, unless they are plain numbers, are left out of the second. The
    threshold is the long ones' median ratio and six robust deviations, which a
    few strings, however long, don't move.
    """
    samples = store_and_release(samples.where("token IS NOT NULL AND random IS NOT NULL"), "strings")
    ordinary, long = samples.where("NOT random"), F.length("token") >= LEAST_RUN
    random = _logs(samples.where("random"))

    def against(tokens: DataFrame) -> MarkovPair:
        return MarkovPair([round(r - o, 6) for r, o in zip(random, _logs(tokens), strict=True)], LEAST_RATIO)

    first = against(ordinary.where(~long))
    number = F.col("token").rlike("^[0-9]+$")
    known = store_and_release(ordinary.where(~long | number | (first.ratio(F.col("token")) < LEAST_RATIO)), "ordinary")
    model = against(known)
    # Stored, so that the model's table is in one plan and each string is walked once for both medians.
    judged = store_and_release(known.where(long).select(model.ratio(F.col("token")).alias("r")), "ratios")
    median = judged.agg(F.median("r").alias("m")).first()["m"]
    if median is not None:
        deviation = judged.agg(F.median(F.abs(F.col("r") - median)).alias("d")).first()["d"]
        model.threshold = max(LEAST_RATIO, median + DEVIATIONS * 1.4826 * deviation)
    return model


def _joined(spans: Column) -> Column:
    names = F.array(*(F.lit(k) for k in (*KINDS, ADDED)))
    return F.array_join(F.transform(spans, lambda m: F.concat_ws(":", F.get(names, m["kind"]), m["start"], m["end"])), ",")


def _of_kind(kind: int) -> Callable[[Column], Column]:
    """Spark gives a second parameter of a function the element's place, so the kind is bound out here."""
    return lambda m: m["kind"] == kind


def scan(docs: DataFrame, model: MarkovPair | None = None) -> DataFrame:
    """``doc_id``, ``n_assign``, ``n_access``, ``n_hex``, ``base_sha256``, ``spans`` and ``n_added`` of every whole ``text``.

    Without a model it is trained from ``labelled_samples``. Null and empty texts
    have no spans; repeated rows repeat; other columns are ignored; an empty table
    gives no rows. All in the JVM.
    """
    model = model or train(labelled_samples(docs))
    picked = docs.select(F.col("doc_id").cast("long").alias("doc_id"), _text().alias("text"))
    found = picked.withColumn("base", base_spans(F.col("text"))).withColumn("added", model.spans(F.col("text"), F.col("base")))
    counts = [F.size(F.filter("base", _of_kind(k))).cast("long").alias(f"n_{name}") for k, name in enumerate(KINDS)]
    return found.select(
        "doc_id", *counts, F.sha2(_joined(F.col("base")), 256).alias("base_sha256"),
        _joined(F.array_sort(F.concat("base", "added"))).alias("spans"), F.size("added").cast("long").alias("n_added"),
    )


def redact(docs: DataFrame, model: MarkovPair | None = None, mark: str = "[SECRET]") -> DataFrame:
    """``docs`` with every span of ``text`` replaced by ``mark`` (overlapping spans by one), ``n_chars`` to match; null texts stay null.

    All other columns stay as they are, whatever their names; repeated rows repeat;
    an empty table gives no rows. A text and its spans are held by a row at a time.
    """
    model = model or train(labelled_samples(docs))
    found = docs.select(F.struct("*").alias("row"), F.col("text").cast("string").alias("text")).withColumn("base", base_spans(_text()))
    found = found.withColumn("spans", F.array_sort(F.concat("base", model.spans(_text(), F.col("base")))))
    start = F.struct(F.lit(0).cast("long").alias("at"), F.lit("").alias("out"))

    def step(acc: Column, m: Column) -> Column:
        gap = F.substr(F.col("text"), (acc["at"] + 1).cast("int"), (m["start"] - acc["at"]).cast("int"))
        fresh = m["start"] >= acc["at"]
        return F.struct(
            F.greatest(acc["at"], m["end"]).alias("at"), F.when(fresh, F.concat(acc["out"], gap, F.lit(mark))).otherwise(acc["out"]).alias("out"))

    walked = F.aggregate("spans", start, step)
    clean = F.when(F.size("spans") > 0, F.concat(walked["out"], F.substr(F.col("text"), (walked["at"] + 1).cast("int")))).otherwise(F.col("text"))
    out = found.withColumn("clean", clean)
    replaced = {"text": F.col("clean").cast(docs.schema["text"].dataType)}
    if "n_chars" in docs.columns:
        changed = F.when(F.size("spans") > 0, F.length("clean")).otherwise(F.col("row.n_chars"))
        replaced["n_chars"] = changed.cast(docs.schema["n_chars"].dataType)
    return out.select(*[replaced.get(c, F.col("row")[c]).alias(c) for c in docs.columns])
