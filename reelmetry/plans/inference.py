"""Inference: raw frames to features to predictions."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelmetry.functions.pixels import frame_features, size_error
from reelmetry.operators.frames import Decoder, decode_frames, resize_frames, split_raw_outcomes, with_features
from reelmetry.schemas import THUMB_HEIGHT, THUMB_WIDTH, FrameShape
from reelmetry.sources.files import MP4_GLOB, raw_file_frames, read_binary
from reelmetry.sources.tables import load_model
from reelmetry.streaming.outcomes import write_counts, write_outcomes


def score_frames(frames: DataFrame, model: PipelineModel, shape: FrameShape = FrameShape()) -> DataFrame:
    """Predictions for raw frames, batch or stream; frames of a wrong size drop out."""
    resized = resize_frames(frames, shape).filter("error is null").drop("error")
    return model.transform(with_features(resized))


def score_outcomes(frames: DataFrame, model: PipelineModel, shape: FrameShape = FrameShape(), height: int = THUMB_HEIGHT, width: int = THUMB_WIDTH) -> DataFrame:
    """``score_frames`` that keeps the bad frames: no data and no prediction, and a message in ``error``.

    One kernel makes thumbnail and features, so a frame is converted once. A bad
    frame passes the model as zeros, and what the model says of it is nulled. An
    ``error`` that the frames have already stays.
    """
    known = F.col("error") if "error" in frames.columns else F.lit(None).cast("string")
    made = frames.withColumns({"_made": frame_features(F.col("data"), shape, height, width), "error": F.coalesce(known, size_error(F.col("data"), shape))})
    ready = made.withColumns({"data": F.col("_made.data"), "features": array_to_vector("_made.features")}).drop("_made")
    scored = model.transform(ready)
    return scored.withColumns({c: F.when(F.col("error").isNull(), F.col(c)) for c in scored.columns if c not in frames.columns and c != "error"})


def infer(spark: SparkSession, video_path: str, model_path: str, out_path: str, decoder: Decoder | None = None,
          shape: FrameShape = FrameShape(), glob: str = MP4_GLOB, open_in_task: bool = False) -> int:
    """The inference job: videos to a Parquet table of predictions; returns how many there are.

    Good and bad frames lie apart (``failed=false``, ``failed=true``), their counts in
    ``_counts``, which readers of the table pass over. Without a decoder the containers are taken as raw frames back to back; what is
    left after the last whole frame is a bad one. ``open_in_task``: read the files in
    the tasks, for videos of any size.
    """
    videos = read_binary(spark, video_path, glob)
    if decoder:
        frames = decode_frames(videos, decoder, open_in_task=open_in_task)
    elif open_in_task:
        frames = raw_file_frames(spark, video_path, shape, glob)
    else:
        frames = split_raw_outcomes(videos, shape)
    counts = write_outcomes(score_outcomes(frames, load_model(model_path), shape), out_path)
    write_counts(spark, counts, f"{out_path.rstrip('/')}/_counts")
    return counts[0] - counts[1]
