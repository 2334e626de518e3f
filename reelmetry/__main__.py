"""Command line: ``spark-submit ... -m reelmetry <job>`` or ``python -m reelmetry <job>``."""

from __future__ import annotations

import argparse
from collections.abc import Sequence

from pyspark.sql import SparkSession

from reelmetry.operators.frames import video_decoder
from reelmetry.plans import analysis, etl, inference, ingest, training
from reelmetry.plans.producer_report import producer_stats
from reelmetry.schemas import IngestConfig
from reelmetry.session import build_session
from reelmetry.sinks.tables import write_image_list, write_parquet, write_report
from reelmetry.sources.files import missing_files, read_label_texts, read_metric_files
from reelmetry.streaming.jobs import run_with_restarts


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="reelmetry", description=__doc__)
    parser.add_argument("--input-gb", type=float, help="size of the input, to size the shuffles")
    jobs = parser.add_subparsers(dest="job", required=True)

    def job(name: str, text: str, *required: str) -> argparse.ArgumentParser:
        one = jobs.add_parser(name, help=text)
        for option in required:
            one.add_argument(f"--{option}", required=True)
        return one

    job("report", "per-producer statistics as a text report", "data", "out")
    job("analyze", "correlation, decomposition, bottleneck and efficiency tables", "data", "out")
    lists = job("image-list", "label text files to an image list", "images", "out")
    lists.add_argument("texts", nargs="+")
    one = job("train", "train the classifiers and save the best", "list", "images", "model")
    one.add_argument("--fraction", type=float, default=0.01)
    one = job("infer", "score the frames of videos", "videos", "model", "out")
    one.add_argument("--raw", action="store_true", help="containers hold raw frames")
    one.add_argument("--open-in-task", action="store_true", help="read files in the tasks, for files above 2 GB")
    one = job("copy-table", "database table to CSV", "url", "table", "out")
    one.add_argument("--partition-column")
    one.add_argument("--bounds", type=int, nargs=2)
    one.add_argument("--partitions", type=int, default=1)
    one = job("ingest", "videos to frame messages", "videos", "servers", "checkpoint")
    one.add_argument("--table", help="folder for errors and counts; beside the checkpoint if not given")
    one.add_argument("--topic", default="video-stream")
    one.add_argument("--frame-rate", type=int, default=1, help="frames per second to send")
    one.add_argument("--source-rate", type=float, help="frames per second in the files; without it all frames are sent")
    one.add_argument("--raw", action="store_true", help="containers hold raw frames")
    one = job("resize", "frame topic to thumbnail topic", "servers", "checkpoint")
    one.add_argument("--table", help="folder for thumbnails, errors and counts; beside the checkpoint if not given")
    one.add_argument("--min-partitions", type=int, help="tasks that read the topic, at least")
    one.add_argument("--records-per-batch", type=int, help="records of a micro-batch, at most")
    job("consume", "consumer metrics of the frame topic", "servers", "out", "checkpoint")
    return parser


def run(spark: SparkSession, argv: Sequence[str]) -> None:
    args = _parser().parse_args(argv)
    decoder = None if getattr(args, "raw", True) else video_decoder()
    if "table" in args and "checkpoint" in args:
        args.table = args.table or f"{args.checkpoint.rstrip('/')}.table"
    if args.job == "report":
        samples = read_metric_files(spark, args.data)
        missing_files(samples).show(truncate=False)
        write_report(producer_stats(samples), args.out)
    elif args.job == "analyze":
        for name, table in analysis.full_report(read_metric_files(spark, args.data)).items():
            write_parquet(table, f"{args.out.rstrip('/')}/{name}")
    elif args.job == "image-list":
        write_image_list(read_label_texts(spark, args.texts, args.images), args.out)
    elif args.job == "train":
        training.train(spark, args.list, args.images, args.model, args.fraction).show(truncate=False)
    elif args.job == "infer":
        print(inference.infer(spark, args.videos, args.model, args.out, decoder, open_in_task=args.open_in_task), "predictions")
    elif args.job == "copy-table":
        bounds = tuple(args.bounds) if args.bounds else None
        etl.copy_database_table(spark, args.url, args.table, args.out, partition_column=args.partition_column,
                                bounds=bounds, partitions=args.partitions)
    elif args.job == "ingest":
        config = IngestConfig(args.videos, args.servers, args.topic, frame_rate=args.frame_rate, source_rate=args.source_rate)
        run_with_restarts(lambda: ingest.ingest(spark, config, args.checkpoint, args.table, decoder))
    elif args.job == "resize":
        run_with_restarts(lambda: ingest.resize(
            spark, args.servers, args.checkpoint, args.table, min_partitions=args.min_partitions, records_per_batch=args.records_per_batch))
    elif args.job == "consume":
        run_with_restarts(lambda: ingest.consume(spark, args.servers, args.out, args.checkpoint))


if __name__ == "__main__":
    import sys

    size = _parser().parse_args().input_gb
    run(build_session(input_bytes=int(size * 1024**3) if size else None), sys.argv[1:])
