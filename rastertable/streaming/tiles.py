"""Streams of tile requests over static layers.

The operations need no state: each micro-batch of requests is joined with the tiles, so the same
functions serve batch and stream.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.classes import ColorMap
from ..model import Layer
from ..operators.requests import read_tiles_zoomed
from ..plans.lineage import run_folder


def answer_requests(requests: DataFrame, levels: Sequence[Layer], max_zoom: int | None = None,
                    overzoom: bool = True, colors: ColorMap | None = None) -> DataFrame:
    """Requested tiles, or their colours with a colour map (band 0)."""
    found = read_tiles_zoomed(requests, levels, max_zoom, overzoom)
    if colors is None:
        return found
    return found.withColumn("rgba", F.transform(
        F.get("bands", F.lit(0)), lambda v: colors.column(v))).drop("bands")


def serve_requests(requests: DataFrame, levels: Sequence[Layer],
                   sink: Callable[[DataFrame, int], None], interval: str = "150 milliseconds",
                   checkpoint: str | None = None, **options) -> StreamingQuery:
    """Answer a stream of requests in batches, one per interval, and hand each to ``sink``.

    Each micro-batch is answered as a batch of its own: only the levels and keys that it asks for are
    read. The checkpoint lies in the shared folder unless a location is given.
    """
    place = checkpoint or run_folder(requests.sparkSession, "requests")

    def answer(batch: DataFrame, number: int) -> None:
        sink(answer_requests(batch, levels, **options), number)

    return (requests.writeStream.foreachBatch(answer).trigger(processingTime=interval)
            .option("checkpointLocation", place).start())
