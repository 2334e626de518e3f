"""Streams of tables that are one file, a folder of files, or a partitioned folder."""

import pytest

import __spark_entry__ as E

#: A query, its table, and the column that parts the folder.
STREAMED = [
    ("stream_ingest_counts", "documents", "lang"),
    ("stream_ingest_errors", "documents", "lang"),
    ("stream_isolated_errors", "documents", "lang"),
    ("stream_raw_frames", "documents", "lang"),
    ("stream_resize_outcomes", "embeddings", "label"),
    ("stream_resized_frames", "embeddings", "label"),
]
DOCUMENTS = [
    (1, "a" * 64 + "b" * 70, "en", "wiki"), (2, "c" * 63, "de", "book"), (3, "", "en", "wiki"), (4, "é" * 64, "fr", "news"), (5, None, None, "wiki"),
    (6, "d" * 128, "en", "forum"),
]
EMBEDDINGS = [(i, i % 3, [((i * 7 + k * 5) % 41 - 20) / 20 for k in range(64)]) for i in range(1, 24)]


def written(spark, folder, layout, table, parted):
    if table == "documents":
        df = spark.createDataFrame(DOCUMENTS, "doc_id long, text string, lang string, source string")
    else:
        df = spark.createDataFrame(EMBEDDINGS, "vec_id long, label int, embedding array<float>")
    at = f"{folder}/{layout}"
    if layout == "one_file":
        df.coalesce(1).write.parquet(f"{folder}/written")
        (folder / layout).mkdir()
        next((folder / "written").glob("part-*.parquet")).rename(folder / layout / f"{table}.parquet")
    elif layout == "folder":
        df.repartition(3).write.parquet(f"{at}/{table}.parquet")
    else:
        df.write.partitionBy(parted).parquet(f"{at}/{table}.parquet")
    return at


def rows(df):
    return sorted(map(str, df.select(*sorted(df.columns)).collect()))


@pytest.mark.parametrize("query, table, parted", STREAMED)
def test_every_file_of_a_table_is_streamed(spark, tmp_path, query, table, parted):
    found = {layout: rows(E.queries()[query](spark, written(spark, tmp_path, layout, table, parted))) for layout in ("one_file", "folder", "partitioned")}
    assert found["one_file"]
    assert found["folder"] == found["partitioned"] == found["one_file"]
