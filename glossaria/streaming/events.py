"""Event streams: windows with a watermark, sessions, and a latest-value table kept by micro-batches."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener
from pyspark.sql.types import StructType

from glossaria.workspace import hadoop_path, new_path

SCHEMA = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"


def event_stream(spark: SparkSession, path: str, files_per_batch: int = 4) -> DataFrame:
    """The event table as a stream of files; event time is a timestamp in the session's zone."""
    path = f"{path[:-1]}[{path[-1]}]"  # as a pattern it may name a folder or a single file; a plain path must be a folder
    stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", files_per_batch).parquet(path)
    return stream.withColumn("ts", F.col("ts").cast("timestamp"))


def tumbling(events: DataFrame, length: str = "1 hour", late: str = "2 hours") -> DataFrame:
    """Counts and sums per window and type; events more than ``late`` behind are dropped with their state."""
    windows = events.withWatermark("ts", late).groupBy(F.window("ts", length).alias("w"), "event_type").agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("value"))
    return windows.select(F.col("w.start").alias("hour"), "event_type", "n", "value")


def sliding(events: DataFrame, length: str = "1 hour", step: str = "15 minutes", late: str = "2 hours") -> DataFrame:
    windows = events.withWatermark("ts", late).groupBy(F.window("ts", length, step).alias("w"), "event_type").agg(F.count(F.lit(1)).alias("n"))
    return windows.select(F.col("w.start").alias("start"), "event_type", "n")


def sessions(events: DataFrame, gap: str = "30 minutes", late: str = "2 hours") -> DataFrame:
    """Sessions of a user: events no more than ``gap`` apart."""
    s = events.withWatermark("ts", late).groupBy("user_id", F.session_window("ts", gap).alias("w")).agg(F.count(F.lit(1)).alias("n"))
    return s.select("user_id", F.col("w.start").alias("start"), "n")


def run_to_end(stream: DataFrame, mode: str, each: Callable[[DataFrame, int], None], log: str) -> None:
    """Process all that is there and stop. ``log`` is the folder of the checkpoint: run again with the same one, a stream goes on where it stood."""
    query = stream.writeStream.outputMode(mode).option("checkpointLocation", log).trigger(availableNow=True).foreachBatch(each).start()
    query.awaitTermination()


def to_table(stream: DataFrame, name: str, mode: str = "complete") -> DataFrame:
    """Run a stream to its end; its result as a table in the shared folder.

    In mode complete it is the last result of all windows; in mode append each window once, when the watermark has
    passed it: a batch that runs again after a failure replaces its own rows.
    """
    spark, path = stream.sparkSession, new_path(stream.sparkSession, name)

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(path if mode == "complete" else f"{path}/batch={batch_id}")

    run_to_end(stream, mode, write, new_path(spark, f"{name}-log"))
    fs, folder = hadoop_path(spark, path)
    if not fs.exists(folder):
        return spark.createDataFrame([], stream.schema)
    return spark.read.schema(stream.schema).parquet(path).select(*stream.columns)


class LatestTable:
    """The latest values per key of a stream, kept in a folder: a base and one small delta per batch since.

    A batch writes only its own keys; every ``compact_every`` batches base and deltas become the next base, so the
    work per batch follows the batch, not the table. All state lies in the folder: which parts are whole is seen from
    their _SUCCESS files, so a new driver with the same folder goes on where the last one stood, and a batch
    that runs again writes the same delta again. Parts that a newer base holds are dropped a compaction later, so
    a reader that has listed them can finish.
    """

    def __init__(self, spark: SparkSession, root: str, keys: list[str], order: str, values: list[str], schema: StructType, compact_every: int = 16) -> None:
        self.spark, self.root, self.keys, self.order, self.values, self.every = spark, root.rstrip("/"), keys, order, values, compact_every
        self.schema = spark.createDataFrame([], schema).select(*keys, order, *values).schema

    def parts(self) -> tuple[int, list[int]]:
        """The newest whole base (-1: none) and the whole deltas after it."""
        fs, folder = hadoop_path(self.spark, self.root)
        names = [s.getPath().getName() for s in fs.listStatus(folder)] if fs.exists(folder) else []
        whole = [n for n in names if n.startswith(("base-", "delta-")) and fs.exists(hadoop_path(self.spark, f"{self.root}/{n}/_SUCCESS")[1])]
        base = max((int(n[5:]) for n in whole if n.startswith("base-")), default=-1)
        return base, sorted(int(n[6:]) for n in whole if n.startswith("delta-") and int(n[6:]) > base)

    def _latest(self, rows: DataFrame) -> DataFrame:
        best = F.max_by(F.struct(*self.values), F.col(self.order))
        return rows.groupBy(*self.keys).agg(best.alias("_v"), F.max(self.order).alias(self.order)).select(*self.keys, self.order, "_v.*")

    def _merged(self, base: int, deltas: list[int]) -> DataFrame:
        paths = [f"{self.root}/base-{base}"] * (base >= 0) + [f"{self.root}/delta-{d}" for d in deltas]
        if not paths:
            return self.spark.createDataFrame([], self.schema)
        return self._latest(self.spark.read.schema(self.schema).parquet(*paths))

    def read(self) -> DataFrame:
        return self._merged(*self.parts())

    def upsert(self, batch: DataFrame, batch_id: int) -> None:
        self._latest(batch.select(*self.keys, self.order, *self.values)).write.mode("overwrite").parquet(f"{self.root}/delta-{batch_id}")
        base, deltas = self.parts()
        if len(deltas) >= self.every:
            self._merged(base, deltas).write.mode("overwrite").parquet(f"{self.root}/base-{deltas[-1]}")
            fs, folder = hadoop_path(self.spark, self.root)
            for status in fs.listStatus(folder):
                kind, _, number = status.getPath().getName().partition("-")
                if kind in ("base", "delta") and int(number) < base or kind == "delta" and int(number) == base:
                    fs.delete(status.getPath(), True)


def latest_table(events: DataFrame, keys: list[str], order: str, values: list[str], name: str, root: str | None = None, compact_every: int = 16) -> DataFrame:
    """Bring the table of the latest values per key up to date with all events that are there; see :class:`LatestTable`.

    With a ``root`` of an earlier run it goes on from there; its checkpoint lies in the same folder.
    """
    root = root or new_path(events.sparkSession, name)
    table = LatestTable(events.sparkSession, root, keys, order, values, events.schema, compact_every)
    run_to_end(events, "append", table.upsert, f"{root}/log")
    return table.read()


class Progress(StreamingQueryListener):
    """Reports batches, rows and rows per second of streams to ``say``, at most every ``every`` batches."""

    def __init__(self, say: Callable[[str], None] = print, every: int = 10) -> None:
        self.say, self.every, self.batches, self.rows = say, every, 0, 0

    def onQueryStarted(self, event) -> None:  # noqa: ANN001, N802
        self.batches = self.rows = 0

    def onQueryProgress(self, event) -> None:  # noqa: ANN001, N802
        self.batches += 1
        self.rows += event.progress.numInputRows
        if self.batches % self.every == 0:
            self.say(f"{event.progress.name or event.progress.id}: {self.batches} batches, {self.rows} rows, {event.progress.processedRowsPerSecond:.0f} rows/s")

    def onQueryIdle(self, event) -> None:  # noqa: ANN001, N802
        pass

    def onQueryTerminated(self, event) -> None:  # noqa: ANN001, N802
        self.say(f"ended after {self.batches} batches, {self.rows} rows")
