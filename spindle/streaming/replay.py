"""Replay a table as a stream, in slices.

The table is written once, split by slice, into a staging folder.  A slice is published
by renaming its folder into the stream's input, so all its files appear together and the
slice is one micro-batch, read by as many tasks as it has splits.

``Replay.run`` starts the query, then publishes its slices one after another and waits
after each until the query has processed it (state stays loaded).  The query is stopped
at the end; the next ``run`` on the same checkpoint is a restart, which recovers offsets
and state and takes a batch that failed once more (STR-9).
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from spindle.sources.folders import list_folders, make_folder, move_folder, remove_folder
from spindle.sources.streams import stream_lines

RunFn = Callable[[DataFrame], StreamingQuery]
_PART, _NULL_PART = "_replay_part", "__HIVE_DEFAULT_PARTITION__"


class Replay:
    """A table staged for replay; ``slices`` lists its slice numbers in order.

    Rows with a NULL slice go with the first slice.  ``spark`` is the session that the
    stream belongs to.
    """

    def __init__(self, spark: SparkSession, source: DataFrame, slice_col: str, folder: str):
        self.spark, self.schema, self.folder = spark, source.schema, folder
        source.withColumn(_PART, F.col(slice_col)).write.partitionBy(_PART).parquet(f"{folder}/staged")
        make_folder(spark, f"{folder}/input")
        found = [n.split("=")[1] for n in list_folders(spark, f"{folder}/staged") if n.startswith(_PART)]
        self.slices = sorted(int(n) for n in found if n != _NULL_PART)
        if _NULL_PART in found:
            self.slices = self.slices or [0]
            first = f"{folder}/staged/{_PART}={self.slices[0]}"
            make_folder(spark, first)
            move_folder(spark, f"{folder}/staged/{_PART}={_NULL_PART}", f"{first}/no-slice")

    def publish(self, slice_id: int) -> None:
        """Make a slice visible to the stream, all files at once."""
        move_folder(self.spark, f"{self.folder}/staged/{_PART}={slice_id}", f"{self.folder}/input/slice-{slice_id}")

    def stream(self) -> DataFrame:
        return stream_lines(self.spark, f"{self.folder}/input", "parquet", schema=self.schema,
                            options={"recursiveFileLookup": "true"})

    def run(self, slices: Sequence[int], start: RunFn) -> None:
        """One program run over ``slices``; a failed batch raises its error."""
        query = start(self.stream())
        try:
            query.processAllAvailable()
            for s in slices:
                self.publish(s)
                query.processAllAvailable()
        finally:
            query.stop()

    def close(self) -> None:
        """Remove the staged and published input."""
        remove_folder(self.spark, self.folder)
