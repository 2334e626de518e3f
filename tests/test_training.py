"""Reproducible splits, F1, model search, saved models, the two jobs."""

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from reelmetry.operators import labels as L
from reelmetry.operators.frames import with_features
from reelmetry.plans import inference, training
from reelmetry.schemas import FrameShape
from reelmetry.sources.files import read_image_list

SF = "/root/testdata/sf0.001"


def test_buckets_do_not_depend_on_partitioning(spark):
    df = spark.range(20_000).withColumnRenamed("id", "key")

    def parts(frame):
        rows = L.with_fold(L.with_split(frame, "key"), "key").orderBy("key").collect()
        return [(r.split, r.fold) for r in rows]

    first = parts(df.repartition(3))
    assert first == parts(df.repartition(11, "key"))
    train = np.mean([s == "train" for s, _ in first])
    folds = np.bincount([f for _, f in first]) / len(first)
    assert abs(train - 0.8) < 0.02 and np.all(np.abs(folds - 1 / 3) < 0.02)
    kept = {r.key for r in L.down_sample(df, "key", 0.01).collect()}
    assert kept == {r.key for r in L.down_sample(df.repartition(7), "key", 0.01).collect()} and 150 < len(kept) < 250


def test_weighted_f1_equals_the_evaluator(spark):
    rng = np.random.default_rng(1)
    rows = [(float(a), float(b)) for a, b in zip(rng.choice(4, 400, p=[.6, .2, .15, .05]), rng.integers(0, 5, 400))]
    df = spark.createDataFrame(rows, "label double, prediction double").repartition(5)
    got = L.weighted_f1(df).first()
    for metric, value in (("f1", got.f1), ("accuracy", got.accuracy)):
        expected = MulticlassClassificationEvaluator(labelCol="label", metricName=metric).evaluate(df)
        assert abs(value - expected) < 1e-12
    assert got.rows == 400


def test_label_index_by_frequency_then_name(spark):
    df = spark.createDataFrame([(x,) for x in "bbbaaccccdd"], "label string")
    got = {r.label: r.indexedLabel for r in training.index_labels(df).distinct().collect()}
    assert got == {"c": 0.0, "b": 1.0, "a": 2.0, "d": 3.0}


def test_selection_ties_go_to_the_earlier():
    scored = [training.Scored(n, f, None) for n, f in (("Random Forest", 0.5), ("Logistic Regression", 0.7), ("Decision Tree", 0.7))]
    assert training.select_best(scored).name == "Logistic Regression"
    assert training.select_best(scored[::-1]).name == "Decision Tree"


def test_selection_in_a_table(spark):
    df = spark.createDataFrame([(0, "Random Forest", 0.4), (1, "Logistic Regression", 0.6), (2, "Decision Tree", 0.6)], "priority int, model string, f1 double")
    assert training.best_of_table(df).first().model == "Logistic Regression"


def test_default_candidates_use_one_axis_each():
    tries = training.candidates()
    assert [(c.name, len(c.grid), len(c.grid[0])) for c in tries] == [
        ("Random Forest", 2, 1), ("Logistic Regression", 2, 1), ("Decision Tree", 2, 1)]


SMALL = {"trees": (3,), "penalties": (0.1,), "depths": (2,)}


@pytest.fixture(scope="module")
def trained(spark, tmp_path_factory, write_png):
    """Dark and bright pictures of several sizes, one broken, one missing."""
    folder = tmp_path_factory.mktemp("train")
    rng = np.random.default_rng(2)
    lines = ["image_path,label"]
    for i in range(40):
        bright = i % 2
        shape = [(70, 64, 3), (64, 64, 3), (30, 90, 3)][i % 3]
        pixels = rng.integers(0, 100, shape) + 27 * (1 - bright) + 130 * bright
        write_png(folder / f"p{i}.png", pixels.astype(np.uint8))
        lines.append(f"{folder}/p{i}.png,{'bright' if bright else 'dark'}")
    (folder / "bad.png").write_bytes(b"broken")
    lines += [f"{folder}/bad.png,dark", f"{folder}/missing.png,dark"]
    (folder / "list.csv").write_text("\n".join(lines) + "\n")
    model = str(tmp_path_factory.mktemp("model") / "best")
    scores = training.train(spark, str(folder / "list.csv"), str(folder), model, fraction=1.0,
                            tries=training.candidates(**SMALL))
    return folder, model, scores.collect()


def test_training_job(spark, trained):
    folder, model, scores = trained
    assert [r.model for r in scores] == ["Random Forest", "Logistic Regression", "Decision Tree"]
    assert sum(r.best for r in scores) == 1 and max(r.f1 for r in scores) == next(r.f1 for r in scores if r.best)
    listed = read_image_list(spark, str(folder / "list.csv"))
    found = training.image_features(spark, listed, str(folder))
    assert found.count() == 40 and found.columns == ["image_path", "label", "features"]
    assert len(PipelineModel.load(model).stages) == 1


def test_a_long_list_gives_the_same_features(spark, trained, monkeypatch):
    folder, _, _ = trained
    listed = read_image_list(spark, str(folder / "list.csv")).filter("label = 'dark'")
    short = {r.image_path: r.features for r in training.image_features(spark, listed, str(folder)).collect()}
    monkeypatch.setattr(training, "BROADCAST_ROWS", 5)
    assert {r.image_path: r.features for r in training.image_features(spark, listed, str(folder)).collect()} == short
    assert len(short) == 20


def test_models_on_real_embeddings(spark):
    """Features that part the classes only in part: scores lie between chance and certainty, the best is marked."""
    rows = spark.read.parquet(f"{SF}/embeddings.parquet").select(
        "vec_id", F.col("label").cast("string").alias("label"), array_to_vector(F.col("embedding").cast("array<double>")).alias("features"))
    best, scored = training.fit_and_select(training.index_labels(rows), "vec_id", training.candidates(**SMALL))
    assert all(0 <= s.f1 <= 1 for s in scored) and best.f1 == max(s.f1 for s in scored)
    assert best.model.transform(training.index_labels(rows)).filter("prediction IS NULL").isEmpty()


def test_no_readable_image_is_an_error(spark, tmp_path):
    (tmp_path / "bad.png").write_bytes(b"x")
    (tmp_path / "list.csv").write_text(f"image_path,label\n{tmp_path}/bad.png,a\n")
    with pytest.raises(ValueError, match="no readable"):
        training.train(spark, str(tmp_path / "list.csv"), str(tmp_path), str(tmp_path / "m"))


def test_inference_job(spark, trained, tmp_path):
    _, model, _ = trained
    rng = np.random.default_rng(3)
    frames = rng.integers(0, 256, (4, 256, 256, 3), dtype=np.uint8)
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "video_01.mp4").write_bytes(frames.tobytes() + b"rest")
    assert inference.infer(spark, str(tmp_path / "in"), model, str(tmp_path / "out")) == 4
    assert inference.infer(spark, str(tmp_path / "in"), model, str(tmp_path / "out"), open_in_task=True) == 4
    rows = spark.read.parquet(str(tmp_path / "out"))
    assert {"rawPrediction", "probability", "prediction", "frame_seq"} <= set(rows.columns)
    sums = [sum(r[0]) for r in rows.select(vector_to_array("probability")).collect()]
    assert len(sums) == 4 and all(abs(s - 1) < 1e-9 for s in sums)


def test_a_saved_model_predicts_the_same(spark, tmp_path):
    rng = np.random.default_rng(5)
    rows = [(i, bytearray(rng.integers(0, 256, 12, dtype=np.uint8).tobytes()), float(i % 3)) for i in range(60)]
    df = with_features(spark.createDataFrame(rows, "i int, data binary, indexedLabel double"))
    fitted = training.candidates(**SMALL)[1].pipeline.fit(df)
    fitted.write().overwrite().save(str(tmp_path / "m"))

    def table(model):
        return [(r.i, r.prediction, list(r.probability)) for r in model.transform(df).orderBy("i").collect()]

    assert table(fitted) == table(PipelineModel.load(str(tmp_path / "m")))


def test_frames_of_a_wrong_size_are_not_scored(spark):
    shape = FrameShape(4, 4, 3)
    rng = np.random.default_rng(7)
    rows = [(i, bytearray(rng.integers(0, 256, 48, dtype=np.uint8).tobytes()), float(i % 2)) for i in range(20)]
    good = spark.createDataFrame(rows, "i int, data binary, indexedLabel double")
    bad = spark.createDataFrame([(99, bytearray(b"x"), 0.0)], good.schema)
    model = training.candidates(**SMALL)[2].pipeline.fit(with_features(inference.resize_frames(good, shape, 64, 64)))
    got = inference.score_frames(good.union(bad), model, shape).select("i", F.col("prediction")).collect()
    assert sorted(r.i for r in got) == list(range(20))
