"""Names, schemas and fixed values shared by the jobs."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# --- fixed values: the 12 metric names, as file stems, with their display names ---
METRIC_DISPLAY_NAMES = {
    "CPU": "CPU",
    "Memory": "Memory",
    "Disk_read": "Disk read",
    "Disk_write": "Disk write",
    "Network_received": "Network received",
    "Network_sent": "Network sent",
    "Msg_cons_time": "Messages consumption time",
    "Cons_lag": "Consumption lag",
    "Avg_latency": "Average latency",
    "Throughput": "Throughput",
    "Frame_prod": "Frames produced",
    "Msg_cons": "Messages consumed",
}
METRICS = list(METRIC_DISPLAY_NAMES)

# --- fixed values: columns of the correlation matrix ---
CORRELATED_METRICS = [
    "CPU", "Memory", "Disk_read", "Disk_write",
    "Network_received", "Network_sent", "Throughput", "Avg_latency",
]

# --- fixed values: histogram bounds in seconds ---
FRAME_TIME_BUCKETS = [0.01, 0.05, 0.1, 0.5, 1.0]
DEFAULT_BUCKETS = [0.005, 0.01, 0.025, 0.05, 0.075, 0.1, 0.25, 0.5, 0.75, 1.0, 2.5, 5.0, 7.5, 10.0]

# --- fixed values: frame geometry ---
FRAME_WIDTH, FRAME_HEIGHT, FRAME_CHANNELS = 256, 256, 3
THUMB_WIDTH, THUMB_HEIGHT = 64, 64

#: Raw metric file rows: no header, names by position.
METRIC_CSV_SCHEMA = T.StructType([
    T.StructField("timestamp", T.StringType()),
    T.StructField("value", T.DoubleType()),
])

IMAGE_LIST_SCHEMA = T.StructType([
    T.StructField("image_path", T.StringType()),
    T.StructField("label", T.StringType()),
])

#: One decoded frame. The payload is ``data``; the other columns keep the order
#: that a keyless topic loses.
FRAME_SCHEMA = T.StructType([
    T.StructField("video", T.StringType()),
    T.StructField("frame_seq", T.LongType()),
    T.StructField("ts", T.TimestampNTZType()),
    T.StructField("width", T.IntegerType()),
    T.StructField("height", T.IntegerType()),
    T.StructField("channels", T.IntegerType()),
    T.StructField("data", T.BinaryType()),
])


@dataclass(frozen=True)
class FrameShape:
    """Geometry of a headerless 8-bit frame."""

    height: int = FRAME_HEIGHT
    width: int = FRAME_WIDTH
    channels: int = FRAME_CHANNELS

    def __post_init__(self) -> None:
        if min(self.height, self.width, self.channels) <= 0:
            raise ValueError(f"frame sides must be positive: {self}")

    @property
    def nbytes(self) -> int:
        return self.height * self.width * self.channels


@dataclass(frozen=True)
class IngestConfig:
    """Parameters of the ingest job, checked on construction."""

    video_path: str
    bootstrap_servers: str = ""
    topic: str = "video-stream"
    frame: FrameShape = FrameShape()
    frame_rate: int = 1
    video_format: str = "mp4"
    #: Frames per second in the files; with it, frames are thinned to ``frame_rate``.
    source_rate: float | None = None

    def __post_init__(self) -> None:
        for name in ("video_path", "topic", "video_format"):
            if not getattr(self, name):
                raise ValueError(f"{name} must not be empty")
        if self.source_rate is not None and self.source_rate <= 0:
            raise ValueError("source_rate must be positive")
        if self.frame_rate <= 0:
            raise ValueError("frame_rate must be positive")
