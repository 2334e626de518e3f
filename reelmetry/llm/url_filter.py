"""URL filtering: allow and block rules, and gradient-boosted trees on lexical features for the rest."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelmetry.operators.skew import store

#: Labelled URLs that are fitted on at most.
TRAINING_ROWS = 20_000
#: Suffixes with statistics of their own, the commonest among the labelled.
SUFFIXES = 200

FEATURES = (
    "length", "host_length", "path_length", "depth", "labels", "digit_ratio", "entropy", "host_entropy", "parameters", "hyphens",
    "longest_label", "has_fragment", "secure", "suffix_share", "suffix_block_rate", "first_part_length",
)


@dataclass(frozen=True)
class Rule:
    """A verdict for a host, its subdomains, and paths that start with ``path``."""

    host: str
    path: str
    verdict: str

    @property
    def name(self) -> str:
        return self.host + self.path


def lower_ascii(c: Column) -> Column:
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a url; both empty if it is null or has no ``://``."""
    after = F.when(F.instr(url, "://") > 0, F.substr(url, F.instr(url, "://") + 3)).otherwise("")
    authority = F.regexp_extract(after, r"(?s)^[^/?#]*", 0)
    path = F.regexp_extract(F.substr(after, F.length(authority) + 1), r"(?s)^[^?#]*", 0)
    return F.coalesce(lower_ascii(authority), F.lit("")), F.coalesce(path, F.lit(""))


def matching_rule(rules: Sequence[Rule]) -> Column:
    """The longest rule that fits (``rule``, ``verdict``), null if none; of equal length the first given."""
    chosen = F.lit(None).cast("struct<rule:string,verdict:string>")
    for rule in sorted(rules, key=lambda r: len(r.name)):
        fits = ((F.col("host") == rule.host) | F.endswith("host", F.lit("." + rule.host))) & F.startswith("path", F.lit(rule.path))
        named = F.struct(F.lit(rule.name).alias("rule"), F.lit(rule.verdict).alias("verdict"))
        chosen = F.when(fits, named).otherwise(chosen)
    return chosen


def entropy(c: Column) -> Column:
    """Shannon entropy of a text's characters, in bits; 0 for an empty one."""
    letters = F.split(c, "")
    size = F.greatest(F.length(c), F.lit(1))
    shares = F.transform(F.array_distinct(letters), lambda x: (F.size(letters) - F.size(F.array_remove(letters, x))) / size)
    return F.when(F.length(c) == 0, 0.0).otherwise(F.aggregate(shares, F.lit(0.0), lambda a, p: a - p * F.log2(p)))


def lexical_features(df: DataFrame) -> DataFrame:
    """Adds ``suffix`` and the features that need no statistics; needs ``url``, ``host`` and ``path``."""
    url = F.coalesce(F.col("url"), F.lit(""))
    labels = F.split("host", r"\.")
    query = F.regexp_extract(url, r"(?s)^[^?#]*\?([^#]*)", 1)
    inner = F.array_remove(F.split("path", "/"), "")
    columns = {
        "suffix": F.element_at(labels, -1),
        "length": F.length(url),
        "host_length": F.length("host"),
        "path_length": F.length("path"),
        "depth": F.size(inner),
        "labels": F.size(labels),
        "digit_ratio": F.regexp_count(url, F.lit("[0-9]")) / F.greatest(F.length(url), F.lit(1)),
        "entropy": entropy(url),
        "host_entropy": entropy(F.col("host")),
        "parameters": F.size(F.array_remove(F.split(query, "[&;]"), "")),
        "hyphens": F.length("host") - F.length(F.translate("host", "-", "")),
        "longest_label": F.array_max(F.transform(labels, lambda x: F.length(x))),
        "has_fragment": F.contains(url, F.lit("#")).cast("int"),
        "secure": F.startswith(url, F.lit("https://")).cast("int"),
        "first_part_length": F.coalesce(F.length(F.try_element_at(inner, F.lit(1))), F.lit(0)),
    }
    return df.withColumns({k: v if k == "suffix" else v.cast("double") for k, v in columns.items()})


@dataclass
class UrlModel:
    """A fitted model: block rates of suffixes (at most SUFFIXES of them), and the trees (None if the labels were all alike)."""

    suffixes: list[tuple[str, float, float]]
    trees: GBTClassificationModel | None
    constant: str

    def with_suffixes(self, df: DataFrame) -> DataFrame:
        share, rate = F.lit(0.0), F.lit(0.5)
        for suffix, s, r in self.suffixes:
            share = F.when(F.col("suffix") == suffix, s).otherwise(share)
            rate = F.when(F.col("suffix") == suffix, r).otherwise(rate)
        return df.withColumns({"suffix_share": share, "suffix_block_rate": rate})

    def verdicts(self, df: DataFrame) -> DataFrame:
        """Adds ``model_verdict`` and ``block_probability`` to rows with lexical features."""
        if self.trees is None:
            return df.withColumns({"model_verdict": F.lit(self.constant), "block_probability": F.lit(1.0 if self.constant == "block" else 0.0)})
        scored = self.trees.transform(VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(self.with_suffixes(df)))
        probability = vector_to_array("probability")[1]
        return scored.withColumn("block_probability", probability).withColumn(
            "model_verdict", F.when(F.col("block_probability") > 0.5, "block").otherwise("allow"))


def train_url_model(labelled: DataFrame, rows: int = TRAINING_ROWS, trees: int = 10, depth: int = 4) -> UrlModel:
    """Fits on at most ``rows`` distinct rows of ``labelled`` (``url``, ``block`` boolean), those of the smallest url hashes.

    Rows with a null label are left out; null urls are empty ones. With labels of
    one kind only, or none, the model says that kind, or allow.
    """
    host, path = host_and_path(F.col("url"))
    picked = labelled.where("block IS NOT NULL").select("url", F.col("block").cast("double").alias("label")).distinct()
    picked = picked.orderBy(F.xxhash64("url"), "url", "label").limit(rows).withColumns({"host": host, "path": path})
    sample = store(lexical_features(picked), "labelled-urls")
    kinds = {r["label"]: r["n"] for r in sample.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    if len(kinds) < 2:
        return UrlModel([], None, "block" if 1.0 in kinds else "allow")
    total = sum(kinds.values())
    # Smoothed, so that a suffix of one verdict isn't taken for certain.
    suffixes = [
        (r["suffix"], r["n"] / total, (r["blocked"] + 1) / (r["n"] + 2))
        for r in sample.groupBy("suffix").agg(F.count(F.lit(1)).alias("n"), F.sum("label").alias("blocked")).orderBy(F.desc("n"), "suffix").limit(SUFFIXES).collect()
    ]
    model = UrlModel(suffixes, None, "allow")
    ready = VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(model.with_suffixes(sample)).select("features", "label")
    model.trees = GBTClassifier(maxIter=trees, maxDepth=depth, seed=7, cacheNodeIds=False, maxBins=32).fit(ready)
    return model


def judge_urls(pages: DataFrame, rules: Sequence[Rule], labelled: DataFrame | None = None) -> DataFrame:
    """``page_id``, ``host``, ``path``, ``rule``, ``verdict`` and ``block_probability`` of every row.

    The longest fitting rule decides; other urls get the trees' verdict, trained on
    ``labelled`` (``url``, ``block``), or without it on the urls of ``pages`` that a
    rule has labelled. A null url or one without ``://`` has empty host and path,
    fits no rule with a host and is judged by its features. Repeated rows repeat;
    other columns are ignored; an empty table gives no rows.
    """
    host, path = host_and_path(F.col("url"))
    named = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"))
    named = named.withColumns({"host": host, "path": path}).withColumn("match", matching_rule(rules))
    if labelled is None:
        labelled = named.where("match IS NOT NULL").select("url", (F.col("match.verdict") == "block").alias("block"))
    model = train_url_model(labelled)
    judged = model.verdicts(lexical_features(named))
    return judged.select(
        "page_id", "host", "path", F.col("match.rule").alias("rule"), F.coalesce("match.verdict", "model_verdict").alias("verdict"), "block_probability")
