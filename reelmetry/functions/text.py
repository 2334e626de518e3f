"""String, path and label helpers as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values: file name and address patterns ---
VIDEO_NAME = r"^video_[0-9]{2}\.mp4$"
HOST_PORT = r"^([^:]+):\d+$"
#: <producer>/<metric>.csv at the end of a path; a table partitioned by the two (producer= and metric= folders, part files) has the same
SERIES_PATH = r"(?:^|/)(?:producer=)?([^/]+)/(?:metric=)?([^/]+)\.csv(?:/part-[^/]+)?$"


def base_name(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def parent_name(path: Column) -> Column:
    """Name of the folder that holds the file; null for a bare name."""
    return F.try_element_at(F.split(path, "/"), F.lit(-2))


def is_video_name(name: Column) -> Column:
    """Full match of ``video_NN.mp4``."""
    return name.rlike(VIDEO_NAME)


def video_name(number: Column) -> Column:
    return F.format_string("video_%02d.mp4", number)


def join_path(base: str, path: Column) -> Column:
    """Path below ``base``; an absolute path stays as it is."""
    prefix = base if base.endswith("/") or not base else base + "/"
    return F.when(path.startswith("/"), path).otherwise(F.concat(F.lit(prefix), path))


def tokens(line: Column) -> Column:
    """Whitespace-separated words of a line, without empty ends."""
    return F.split(F.regexp_replace(line, r"^\s+|\s+$", ""), r"\s+")


def host_of(address: Column) -> Column:
    """Host of ``host:port``; null when the address has another form."""
    return F.nullif(F.regexp_extract(address, HOST_PORT, 1), F.lit(""))


def scrape_labels(address: Column) -> dict[str, Column]:
    """Labels that a scrape gives its samples, derived from the source address."""
    return {"application": host_of(address), "instance": address, "job": host_of(address)}


def two_decimals(value: Column) -> Column:
    """``%.2f`` text as Python prints it; a missing value prints as nan.

    ``format_number`` rounds the exact binary value half to even, as Python
    does; ``format_string`` would round the shortest decimal text half up.
    """
    text = F.call_function("format_number", value, F.lit("0.00"))
    return F.when(value.isNull(), F.lit("nan")).otherwise(text)


def pad_right(text: Column, width: int) -> Column:
    """Left-aligned to ``width``; longer text is kept whole."""
    return F.when(F.length(text) >= width, text).otherwise(F.rpad(text, F.lit(width), F.lit(" ")))
