"""Training: features, three cross-validated classifiers, the best one saved."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import DecisionTreeClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.feature import StringIndexer
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from reelmetry.functions.pixels import resize_image
from reelmetry.operators.frames import with_features
from reelmetry.operators.labels import down_sample, with_fold, with_split
from reelmetry.operators.skew import BROADCAST_ROWS, rows_within, store
from reelmetry.sinks.tables import save_model
from reelmetry.sources.files import lookup_images, read_image_list, read_images

# --- fixed values: classifier settings and search grids ---
FOREST = {"maxDepth": 5, "numTrees": 10, "maxBins": 16}
FOREST_TREES = [50, 100]
REGRESSION_PENALTIES = [0.1, 0.01]
TREE_DEPTHS = [5, 10]
FOLDS = 3
SEED = 42


@dataclass(frozen=True)
class Candidate:
    name: str
    pipeline: Pipeline
    grid: list


@dataclass(frozen=True)
class Scored:
    name: str
    f1: float
    model: PipelineModel


def index_labels(df: DataFrame, label: str = "label", out: str = "indexedLabel") -> DataFrame:
    """Label index by falling frequency, ties by label."""
    return StringIndexer(inputCol=label, outputCol=out).fit(df).transform(df)


def candidates(label: str = "indexedLabel", features: str = "features", trees=tuple(FOREST_TREES),
               penalties=tuple(REGRESSION_PENALTIES), depths=tuple(TREE_DEPTHS)) -> list[Candidate]:
    """The three classifiers, each with the one grid axis it uses."""
    columns = {"labelCol": label, "featuresCol": features}
    forest = RandomForestClassifier(**columns, **FOREST, seed=SEED)
    regression = LogisticRegression(**columns, family="multinomial")
    tree = DecisionTreeClassifier(**columns, seed=SEED)
    axes = [
        ("Random Forest", forest, forest.numTrees, trees),
        ("Logistic Regression", regression, regression.regParam, penalties),
        ("Decision Tree", tree, tree.maxDepth, depths),
    ]
    return [
        Candidate(name, Pipeline(stages=[stage]), ParamGridBuilder().addGrid(param, list(values)).build())
        for name, stage, param, values in axes
    ]


def f1_evaluator(label: str = "indexedLabel") -> MulticlassClassificationEvaluator:
    return MulticlassClassificationEvaluator(labelCol=label, predictionCol="prediction", metricName="f1")


def cross_validate(candidate: Candidate, training: DataFrame, label: str = "indexedLabel",
                   folds: int = FOLDS, parallelism: int = 2) -> PipelineModel:
    """Best model of a candidate's grid by F1 over the hash folds in ``fold``."""
    validator = CrossValidator(
        estimator=candidate.pipeline, estimatorParamMaps=candidate.grid, evaluator=f1_evaluator(label),
        numFolds=folds, foldCol="fold", parallelism=parallelism, seed=SEED,
    )
    return validator.fit(training).bestModel


def select_best(scored: list[Scored]) -> Scored:
    """Highest F1; on a tie the earlier in candidate order."""
    return max(scored, key=lambda s: s.f1)


def fit_and_select(indexed: DataFrame, key: str, tries: list[Candidate] | None = None,
                   label: str = "indexedLabel") -> tuple[Scored, list[Scored]]:
    """Cross-validate all candidates on the training split, score on the rest."""
    parts = with_fold(with_split(indexed, key), key)
    training, held_out = parts.filter("split = 'train'"), parts.filter("split = 'test'")
    scored = []
    for candidate in tries or candidates(label):
        model = cross_validate(candidate, training, label)
        scored.append(Scored(candidate.name, f1_evaluator(label).evaluate(model.transform(held_out)), model))
    return select_best(scored), scored


def score_table(spark: SparkSession, best: Scored, scored: list[Scored]) -> DataFrame:
    return spark.createDataFrame(
        [Row(priority=i, model=s.name, f1=float(s.f1), best=s is best) for i, s in enumerate(scored)]
    )


def image_features(spark: SparkSession, listed: DataFrame, image_path: str | list[str]) -> DataFrame:
    """Feature vectors of the images in ``listed`` (``image_path`` and more) that can be read.

    A list of checked size is broadcast and picks the images before they are
    shrunk. With a longer one they are shrunk first, so that the join by shuffle
    moves thumbnails, never the images.
    """
    images = read_images(spark, image_path)
    data = resize_image(F.col("image")).alias("data")
    if rows_within(listed, BROADCAST_ROWS):
        found = lookup_images(listed, images).select(*listed.columns, data)
    else:
        found = lookup_images(listed, images.select("path", data))
    return with_features(found.filter(F.col("data").isNotNull())).drop("data")


def train(spark: SparkSession, list_path: str, image_path: str | list[str], model_path: str,
          fraction: float = 0.01, tries: list[Candidate] | None = None) -> DataFrame:
    """The training job. The list is sampled by key first; only the sample's features are made, once, and kept as a table."""
    # The label index is fitted before sampling, on the whole list: it only needs names.
    sampled = store(down_sample(index_labels(read_image_list(spark, list_path)), "image_path", fraction), "sample")
    features = store(image_features(spark, sampled, image_path), "features")
    if features.isEmpty():
        raise ValueError("no readable images in the sampled list")
    best, scored = fit_and_select(features, "image_path", tries)
    save_model(best.model, model_path)
    return score_table(spark, best, scored)


def best_of_table(scores: DataFrame) -> DataFrame:
    """Table form of ``select_best``: highest f1, then lowest priority."""
    return scores.orderBy(F.col("f1").desc(), F.col("priority")).limit(1)
