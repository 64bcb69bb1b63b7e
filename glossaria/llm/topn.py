"""Top N items within every group, skipping what statistics exclude.

1. Cluster: the rows are range-partitioned by (group, score descending) and sorted within each file,
   so a group of any size is spread over as many files as it fills, and a row group of a file holds
   part of one group or a run of whole small groups. Row groups are small (a parameter), as they
   are what is skipped.
2. Statistics: the footers give each row group's first and last group and its greatest score.
3. Read in descending greatest score: first each large group's best row group and all row groups
   in which a group begins. In this order the row in which a group begins is its best one, so no row
   group with a beginning can be below that group's N-th score: the rule itself asks to read it.
   The best row group of a large group yields a current N-th score.
4. Skip: a remaining row group is read only if its greatest score is not strictly below the current
   N-th score of the group it holds. Equal scores are read, since ties are decided by the item.

The result is exact for any data: a group without N items so far has no N-th score and nothing of it
is skipped. A task holds ``ROWS_AT_ONCE`` rows; what leaves it are at most N rows per group and row group.
Nothing is broadcast. Files are read through pyarrow; on a file system it does not know, all rows
are ranked without skipping, with the same result.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import groupby
from urllib.parse import unquote, urlparse

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from glossaria.workspace import materialise, new_path

FOOTER = "file string, rg int, g_min string, g_max string, s_max bigint, n bigint"
#: Rows of a row group, files whose footers one task reads, and rows a task holds at a time.
ROWS_PER_GROUP, FOOTERS_PER_TASK, ROWS_AT_ONCE = 2_000, 16, 64_000
# Names under which Hadoop knows file systems that pyarrow calls otherwise.
_SCHEMES = {"s3a": "s3", "s3n": "s3", "viewfs": "viewfs", "hdfs": "hdfs", "gs": "gs", "abfs": "abfs", "abfss": "abfss"}


def _file_system(path: str):  # noqa: ANN202
    """pyarrow's file system of a path and the path within it; a ValueError if it has none."""
    import pyarrow.fs as pafs

    parts = urlparse(path)
    if parts.scheme in ("", "file"):
        return pafs.LocalFileSystem(), unquote(parts.path)
    if parts.scheme not in _SCHEMES:
        raise ValueError(f"no reader for {parts.scheme}")
    return pafs.FileSystem.from_uri(_SCHEMES[parts.scheme] + path[len(parts.scheme) :])


def _open(path: str):  # noqa: ANN202
    import pyarrow.parquet as pq

    fs, inner = _file_system(path)
    return pq.ParquetFile(fs.open_input_file(inner))


def cluster_by_group(df: DataFrame, rows_per_group: int = ROWS_PER_GROUP, partitions: int | None = None) -> str:
    """Write ``(g, item, score, row_id)`` clustered by group; returns the folder in the shared workspace."""
    path = new_path(df.sparkSession, "clustered")
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    (
        df.repartitionByRange(n, F.col("g"), F.col("score").desc())
        .sortWithinPartitions("g", F.col("score").desc(), "item", "row_id")
        .write.option("parquet.block.row.count.limit", str(rows_per_group))
        .parquet(path)
    )
    return path


def footers(spark, path: str) -> DataFrame:  # noqa: ANN001
    """One row per row group with the statistics of its footer."""
    files = spark.read.parquet(path).inputFiles()

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for file in batch["file"]:
                parquet = _open(file)
                at = {name: i for i, name in enumerate(parquet.schema_arrow.names)}
                rows = []
                for rg in range(parquet.metadata.num_row_groups):
                    meta = parquet.metadata.row_group(rg)
                    g, s = meta.column(at["g"]).statistics, meta.column(at["score"]).statistics
                    rows.append((file, rg, g.min if g else None, g.max if g else None, s.max if s else None, meta.num_rows))
                yield pd.DataFrame(rows, columns=["file", "rg", "g_min", "g_max", "s_max", "n"])

    if not files:
        return spark.createDataFrame([], FOOTER)
    listed = spark.createDataFrame([(f,) for f in files], "file string").repartition(-(-len(files) // FOOTERS_PER_TASK))
    return listed.mapInPandas(read, FOOTER)


def _best_of_row_groups(chosen: DataFrame, n: int) -> DataFrame:
    """The best ``n`` distinct items per group of each chosen row group ``(file, rg, n, alone)``; ``alone`` is handed on."""

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            wanted = sorted(zip(batch["file"], batch["rg"], batch["n"], batch["alone"], strict=True))
            for file, of_file in groupby(wanted, key=lambda w: w[0]):
                parquet = _open(file)
                runs: list[list] = [[]]
                for w in of_file:
                    if runs[-1] and (sum(x[2] for x in runs[-1]) + w[2] > ROWS_AT_ONCE):
                        runs.append([])
                    runs[-1].append(w)
                for run in filter(None, runs):
                    rows = parquet.read_row_groups([int(w[1]) for w in run], columns=["g", "item", "score", "row_id"]).to_pandas()
                    rows["rg"] = [w[1] for w in run for _ in range(w[2])]
                    rows["alone"] = [w[3] for w in run for _ in range(w[2])]
                    # sorted by group, score descending, item, row_id: the first row of an item is its best
                    rows = rows[~rows.duplicated(["g", "item"])]
                    yield rows[rows.groupby(["g", "rg"], sort=False).cumcount() < n].drop(columns="rg")

    width = int(chosen.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    near = F.expr(f"rg div {max(1, ROWS_AT_ONCE // ROWS_PER_GROUP)}")  # row groups that lie together are read together
    return chosen.select("file", "rg", "n", "alone").repartition(width, F.col("file"), near).mapInPandas(read, "g string, item string, score bigint, row_id bigint, alone boolean")


def _rank(df: DataFrame, n: int) -> DataFrame:
    best = df.groupBy("g", "item").agg(F.max(F.struct("score", (-F.col("row_id")).alias("minus"))).alias("b"))
    rows = best.select("g", "item", F.col("b.score").alias("score"), (-F.col("b.minus")).alias("row_id"))
    order = Window.partitionBy("g").orderBy(F.col("score").desc(), "item")
    return rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= n)


def choose(stats: DataFrame, seen_best: DataFrame | None, n: int) -> DataFrame:
    """The row groups ``(file, rg, n, alone)`` of a round.

    In the first (``seen_best`` is None) those in which a group begins, and of each group with row groups of its own
    the best of them; in the second, given what the best ones held, the others that the rule does not exclude.
    """
    several = F.col("g_min").isNull() | (F.col("g_min") != F.col("g_max")) | F.col("s_max").isNull()
    single = stats.where(~several)
    # sorted data: of equal greatest scores the one that comes first; a maximum per group, no order over all its row groups
    best = single.groupBy("g_min").agg(F.max_by(F.struct("file", "rg"), F.struct(F.col("s_max"), -F.col("rg"), "file")).alias("b")).select("g_min", "b.*")
    if seen_best is None:
        alone = single.join(best.hint("merge"), ["g_min", "file", "rg"], "left_semi").withColumn("alone", F.lit(True))
        return stats.where(several).withColumn("alone", F.lit(False)).unionByName(alone).select("file", "rg", "n", "alone")
    # the N-th best of a group's best row group: the N-th of all is not below it
    nth = seen_best.where("alone").groupBy(F.col("g").alias("g_min")).agg(F.min("score").alias("nth"), F.count(F.lit(1)).alias("k")).where(F.col("k") >= n)
    rest = single.join(best.hint("merge"), ["g_min", "file", "rg"], "left_anti").join(nth.hint("merge"), "g_min", "left")
    return rest.where(F.col("nth").isNull() | (F.col("s_max") >= F.col("nth"))).select("file", "rg", "n", F.lit(False).alias("alone"))


def top_n_from_clustered(spark, path: str, n: int) -> DataFrame:  # noqa: ANN001
    """The top ``n`` of every group of a folder written by :func:`cluster_by_group`."""
    try:
        _file_system(path)
    except (ValueError, OSError):
        return _rank(spark.read.parquet(path), n)
    stats = materialise(footers(spark, path), "footers")
    seen = materialise(_best_of_row_groups(choose(stats, None, n), n), "first-best")
    again = _best_of_row_groups(choose(stats, seen, n), n)
    return _rank(seen.unionByName(again), n)


def row_groups_read(spark, path: str, n: int) -> DataFrame:  # noqa: ANN001
    """``(row_groups, read, rows, rows_read)``: how much of a clustered folder the rule reads."""
    stats = materialise(footers(spark, path), "footers")
    first = choose(stats, None, n)
    chosen = first.unionByName(choose(stats, materialise(_best_of_row_groups(first, n), "first-best"), n))
    both = stats.select("n", F.lit(0).alias("r")).unionByName(chosen.select("n", F.lit(1).alias("r")))
    of = [(F.count_if(F.col("r") == r).alias(a), F.coalesce(F.sum(F.when(F.col("r") == r, F.col("n"))), F.lit(0)).alias(b)) for r, a, b in ((0, "row_groups", "rows"), (1, "read", "rows_read"))]
    return both.agg(*[c for pair in of for c in pair]).select("row_groups", "read", "rows", "rows_read")


def clusterable(df: DataFrame, group: str, item: str, score: str, row_id: str) -> DataFrame:
    """``(g, item, score, row_id)`` of the rows that take part."""
    return df.select(
        F.col(group).cast("string").alias("g"), F.col(item).cast("string").alias("item"), F.col(score).cast("bigint").alias("score"), F.col(row_id).cast("bigint").alias("row_id")
    ).where("g is not null and item is not null and score is not null")


def top_n(df: DataFrame, group: str, item: str, score: str, row_id: str, n: int = 3, rows_per_group: int = ROWS_PER_GROUP) -> DataFrame:
    """The ``n`` best distinct items of every group: ``(g, item, score, row_id, rank)``.

    An item stands once per group, by its row of greatest score and then least row id. Items are ordered
    by score descending, then by item ascending in byte order. Rows with a null group or a null score
    take no part; a null item is left out too. Repeated rows make no difference; groups with fewer items
    than ``n`` return what they have; an empty table returns no rows. Other columns are never read.
    """
    return top_n_from_clustered(df.sparkSession, cluster_by_group(clusterable(df, group, item, score, row_id), rows_per_group), n)
