"""Toxicity categories by a chain of linear models, each fed with the earlier categories' probabilities."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import CountVectorizerModel, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelmetry.operators.skew import release, store_and_release

#: Labelled documents that are fitted on at most, folds for the probabilities fed forward.
TRAINING_ROWS, FOLDS = 12_000, 3
#: Lengths of word beginnings that count as features.
STEMS = (4, 5)
#: A word is a feature from this log-likelihood ratio statistic on (seven documents of a category with a tenth of all); at most so many are.
EVIDENCE, MOST_WORDS = 30.0, 4_096
#: Weight of the models' squared coefficients.
RIDGE = 1e-3

#: Columns that scoring makes on the way.
_OWN = ["letters", "words", "shape", "features", "rawPrediction", "probability", "prediction"]


def with_letters(df: DataFrame) -> DataFrame:
    """Adds ``letters`` and ``shape`` (shares of odd characters, capitals, repeats).

    ``letters`` holds the text's distinct lower-cased runs of letters, and the first
    few letters of the longer ones, so that a stem is known in forms not seen before.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    size = F.greatest(F.length(text), F.lit(1))
    df = df.withColumn("letters", F.array_remove(F.split(F.lower(text), r"[^\p{L}]+"), ""))
    words = F.greatest(F.size("letters"), F.lit(1))
    marks = F.length(text) - F.length(F.translate(text, "$%&*#!|@", ""))
    shape = {
        "_marks": marks / size,
        "_capitals": (F.length(text) - F.length(F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", ""))) / size,
        "_repeats": 1 - F.size(F.array_distinct("letters")) / words,
        "_word_length": F.least(size / words, F.lit(50)) / 50,
    }
    df = df.withColumns({k: v.cast("double") for k, v in shape.items()})
    df = VectorAssembler(inputCols=list(shape), outputCol="shape").transform(df).drop(*shape)
    df = df.withColumn("letters", F.array_distinct("letters"))
    return df.withColumn("letters", F.concat("letters", *(_stems(n) for n in STEMS)))


def _stems(length: int) -> Column:
    """The first ``length`` letters of the longer words of ``letters``; the length is bound out here, as Spark gives a second parameter the element's place."""
    longer = F.filter("letters", lambda w: F.length(w) > length)
    return F.transform(longer, lambda w: F.concat(F.substring(w, 1, length), F.lit("~")))


@dataclass
class Link:
    """One category's model: the words it looks at, and its coefficients."""

    words: CountVectorizerModel
    linear: LogisticRegressionModel

    def score(self, df: DataFrame, category: str, earlier: Sequence[str]) -> DataFrame:
        return _judged(self.words.transform(df), self.linear, "words", category, earlier).drop("words")


def _inputs(df: DataFrame, words: str, earlier: Sequence[str]) -> DataFrame:
    return VectorAssembler(inputCols=[words, "shape", *(f"p_{c}" for c in earlier)], outputCol="features").transform(df)


def _judged(df: DataFrame, linear: LogisticRegressionModel, words: str, category: str, earlier: Sequence[str]) -> DataFrame:
    """Adds ``p_<category>``; ``words`` is the column of the model's words."""
    out = linear.transform(_inputs(df, words, earlier))
    return out.withColumn(f"p_{category}", vector_to_array("probability")[1]).drop("features", "rawPrediction", "probability", "prediction")


@dataclass
class Chain:
    """Fitted models in order, and for each the probability from which it speaks."""

    categories: list[str]
    models: list[Link | None]
    thresholds: list[float]

    def score(self, docs: DataFrame) -> DataFrame:
        """``docs`` with ``p_<category>`` and ``is_<category>`` for every category; clashing columns are replaced."""
        added = [f"{k}_{c}" for c in self.categories for k in ("p", "is")]
        out = with_letters(docs.drop(*_OWN, *added))
        for i, (category, model) in enumerate(zip(self.categories, self.models, strict=True)):
            out = out.withColumn(f"p_{category}", F.lit(0.0)) if model is None else model.score(out, category, self.categories[:i])
        flags = {f"is_{c}": F.col(f"p_{c}") >= t for c, t in zip(self.categories, self.thresholds, strict=True)}
        return out.drop(*_OWN).withColumns(flags)


def _telling_words(counts: DataFrame, category: str, base: float) -> list[str]:
    """Words whose documents have the category clearly more or less often than all, the clearest first.

    ``counts`` has ``letter``, ``n`` and ``t``, its documents and those of the category.
    """
    def term(part, expected):
        return F.when(part > 0, part * F.log(part / expected)).otherwise(0.0)

    n, t = F.col("n"), F.col("t")
    statistic = 2 * (term(t, n * base) + term(n - t, n * (1 - base)))
    found = counts.withColumn("g", statistic).where(F.col("g") >= EVIDENCE).orderBy(F.desc("g"), "letter").limit(MOST_WORDS)
    return [r["letter"] for r in found.select("letter").collect()]


def _words_model(vocabulary: Sequence[str], column: str) -> CountVectorizerModel:
    """Marks which words of ``vocabulary`` are among ``letters``."""
    words = CountVectorizerModel.from_vocabulary(list(vocabulary), inputCol="letters", outputCol=column)
    words.setBinary(True)
    return words


def _vocabularies(base: DataFrame, counted: DataFrame, category: str, folds: int) -> list[list[str] | None]:
    """The words of the category's model of all rows, and of those that leave out each fold; None where the labels are all alike."""
    sums = base.groupBy("fold").agg(F.count(F.lit(1)).alias("n"), F.sum(category).alias("t")).collect()
    found: list[list[str] | None] = []
    for left_out in (None, *range(folds)):
        n, t = (sum(r[k] for r in sums if r["fold"] != left_out) for k in ("n", "t"))
        if not 0 < t < n:
            found.append(None)
            continue
        rows = counted if left_out is None else counted.where(F.col("fold") != left_out)
        counts = rows.groupBy("letter").agg(F.sum("n").alias("n"), F.sum(f"t_{category}").alias("t"))
        # One word at least: "~" is no run of letters.
        found.append(_telling_words(counts, category, t / n) or ["~"])
    return found


def _with_words(base: DataFrame, columns: dict[str, list[str]]) -> DataFrame:
    """``base`` with a column of marked words for every vocabulary instead of ``letters``.

    The fits read these; the strings, far larger, are gone through once and not
    again in each pass of each fit.
    """
    out = base
    for column, vocabulary in columns.items():
        out = _words_model(vocabulary, column).transform(out)
    slim = [F.col(c).alias(c, metadata={"ml_attr": {"num_attrs": len(v)}}) for c, v in columns.items()]
    return out.select(*(c for c in base.columns if c != "letters"), *slim)


def _fit(rows: DataFrame, words: str, category: str, earlier: Sequence[str]) -> LogisticRegressionModel:
    """A model of one category; ``words`` is the column of its words."""
    linear = LogisticRegression(labelCol=category, featuresCol="features", regParam=RIDGE, standardization=False, maxIter=25, tol=1e-4)
    model = linear.fit(_inputs(rows, words, earlier).select("features", category))
    release(rows.sparkSession)  # a job per iteration
    return model


def _best_threshold(rows: DataFrame, category: str) -> float:
    """The out-of-fold probability with the highest F1, midway to the next lower one."""
    binned = rows.groupBy(F.floor(F.col(f"p_{category}") * 1000).alias("bin")).agg(F.count(F.lit(1)).alias("n"), F.sum(category).alias("true")).collect()
    wanted = sum(r["true"] for r in binned)
    best, at, flagged, hit = -1.0, 0.5, 0, 0.0
    levels = sorted(binned, key=lambda r: -r["bin"])
    for i, r in enumerate(levels):
        flagged += r["n"]
        hit += r["true"]
        f1 = 2 * hit / (flagged + wanted)
        if f1 > best:
            below = levels[i + 1]["bin"] + 1 if i + 1 < len(levels) else r["bin"]
            best, at = f1, (r["bin"] + below) / 2000
    return at


def train_chain(docs: DataFrame, labels: DataFrame, categories: Sequence[str], rows: int = TRAINING_ROWS, folds: int = FOLDS) -> Chain:
    """Fits the chain on at most ``rows`` labelled documents, those of the smallest id hashes.

    ``labels`` has ``doc_id`` and a 0/1 column per category; rows with a null label
    or id are left out, of repeated ids one is taken. For each category and fold a
    model of the other folds gives the fold's probabilities: later models learn
    from these, not from probabilities of documents their makers had seen, and the
    category's threshold is the one of the highest F1 over them. A category whose
    labels are all alike gets no model and probability 0.
    """
    categories = list(categories)
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), *(F.col(c).cast("double").alias(c) for c in categories))
    known = known.dropna().dropDuplicates(["doc_id"]).orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    # Bounded by ``rows``.
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(known), "doc_id")
    # Equal texts in one fold, else a copy would tell its label.
    texts = texts.dropDuplicates(["doc_id"]).withColumn("fold", F.pmod(F.xxhash64("text"), F.lit(folds)))
    base = store_and_release(with_letters(texts).drop("text").coalesce(8), "labelled")
    counted = store_and_release(
        base.select("fold", *categories, F.explode("letters").alias("letter")).groupBy("letter", "fold")
        .agg(F.count(F.lit(1)).alias("n"), *(F.sum(c).alias(f"t_{c}") for c in categories)),
        "words",
    )
    vocabularies = {c: _vocabularies(base, counted, c, folds) for c in categories}
    # Per category the column of the model of all rows, then those of the folds' models.
    columns = {c: [f"words_{i}_{n}" for n in range(folds + 1)] for i, c in enumerate(categories)}
    base = store_and_release(_with_words(base, {k: v for c in categories for k, v in zip(columns[c], vocabularies[c], strict=True) if v}), "marked")
    models: list[Link | None] = []
    thresholds: list[float] = []
    for i, category in enumerate(categories):
        earlier = categories[:i]
        (vocabulary, *others), (column, *fold_columns) = vocabularies[category], columns[category]
        if vocabulary is None:
            models.append(None)
            base = base.withColumn(f"p_{category}", F.lit(0.0))
            thresholds.append(1.1)
            continue
        linear = _fit(base, column, category, earlier)
        models.append(Link(_words_model(vocabulary, "words"), linear))
        scored = None
        for fold, (words, own) in enumerate(zip(others, fold_columns, strict=True)):
            maker, own = (_fit(base.where(F.col("fold") != fold), own, category, earlier), own) if words else (linear, column)
            part = _judged(base.where(F.col("fold") == fold), maker, own, category, earlier).drop(*columns[category])
            scored = part if scored is None else scored.unionByName(part)
        base = store_and_release(scored, "out-of-fold")
        thresholds.append(_best_threshold(base, category))
    return Chain(categories, models, thresholds)


#: The pipeline's chain: poor quality first, then toxicity.
CATEGORIES = ("poor", "toxic")


def category_labels(labels: DataFrame) -> DataFrame:
    """The label table's ``quality`` and ``toxic`` as categories."""
    return labels.select("doc_id", (1 - F.col("quality")).alias("poor"), F.col("toxic").alias("toxic"))


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id``, ``p_poor``, ``p_toxic``, ``toxic`` of every whole ``text``; the chain is trained from ``labels``.

    Null and empty texts are scored as texts without words; null ids and repeated
    rows are scored like others; other columns are ignored; an empty document table
    gives no rows, an empty label table calls nothing toxic.
    """
    chain = train_chain(docs, category_labels(labels), CATEGORIES)
    scored = chain.score(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"))
    return scored.select("doc_id", "p_poor", "p_toxic", F.col("is_toxic").alias("toxic"))


def keep_civil(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that the chain doesn't call toxic, all columns as they were."""
    chain = train_chain(docs, category_labels(labels), CATEGORIES)
    own = docs.select(F.struct(*docs.columns).alias("_row"), F.col("text"))
    return chain.score(own).where(~F.col("is_toxic")).select("_row.*")
