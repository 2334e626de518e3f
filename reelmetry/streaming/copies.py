"""Each frame of a video once, however often and however late its copies come."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

#: Frames of a video that share a state row: a bit each.
BLOCK_FRAMES = 4096
#: Names that a row tuple may have: no underscore in front.
_OWN = ["copies_block", "copies_place"]


class FirstCopies(StatefulProcessor):
    """Passes on the first copy of every frame of a block of a video; the state is a bit per frame, none once all have come."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.seen = handle.getValueState("seen", "bits binary")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        if key[1] is None:  # no frame number: nothing tells copies apart
            for part in rows:
                yield part.drop(columns=_OWN)
            return
        known = bytes(self.seen.get()[0]) if self.seen.exists() else bytes(BLOCK_FRAMES // 8)
        if not known:
            for _ in rows:
                pass
            return
        bits = np.unpackbits(np.frombuffer(known, dtype=np.uint8)).astype(bool)
        for part in rows:
            place = part["copies_place"].to_numpy().astype(np.int64)
            fresh = ~bits[place] & ~pd.Series(place).duplicated().to_numpy()
            bits[place] = True
            if fresh.any():
                yield part[fresh].drop(columns=_OWN)
        self.seen.update((b"" if bits.all() else np.packbits(bits).tobytes(),))

    def close(self) -> None:
        pass


def first_copies(frames: DataFrame) -> DataFrame:
    """The rows of a stream with ``video`` and ``frame_seq``, each pair once.

    State is keyed by (video, block of BLOCK_FRAMES frames): a bit per frame instead
    of a row, so it can be kept for good and needs no time limit within which copies
    must come; a long video spreads over many keys. Rows without a frame number
    all pass. Payloads travel with the rows, so use it on what is small (thumbnails).
    Needs ``ticks.rocks_db`` when it is started.
    """
    kept = [f for f in frames.schema.fields if f.name not in _OWN]
    # As text: a number beside nulls would come to the processor as a float, and the key would be another.
    block = F.floor(F.col("frame_seq") / BLOCK_FRAMES).cast("string")
    place = F.pmod(F.col("frame_seq"), F.lit(BLOCK_FRAMES))
    keyed = frames.select(*[f.name for f in kept], block.alias("copies_block"), F.coalesce(place, F.lit(-1)).alias("copies_place"))
    return keyed.groupBy("video", "copies_block").transformWithStateInPandas(FirstCopies(), T.StructType(kept), "append", "None")
