"""Writers. Data stay distributed; what is one file by nature is put together by streaming its parts, never in memory."""

from __future__ import annotations

import json
import os
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from glossaria.sources.files import _lines
from glossaria.workspace import hadoop_path, new_path


def write_tsv(df: DataFrame, path: str, columns: list[str], order: list[str | Column], comments: list[str] | None = None) -> None:
    """Tab-separated text, sorted by ``order`` across its part files; white space inside a cell becomes one space.

    ``comments`` stand as # lines before the first row. Nulls are empty cells.
    """
    cells = [F.coalesce(F.trim(F.regexp_replace(F.col(c).cast("string"), r"\s+", " ")), F.lit("")) for c in columns]
    lines = df.orderBy(*order).select(F.concat_ws("\t", *cells).alias("value"))
    if comments:
        head = df.sparkSession.createDataFrame([(f"# {c}",) for c in comments], "value string").coalesce(1)
        head.write.mode("overwrite").text(os.path.join(path, "head"))
        lines.write.mode("overwrite").text(os.path.join(path, "rows"))
    else:
        lines.write.mode("overwrite").text(path)


def write_frequencies(df: DataFrame, path: str, least: int = 1) -> None:
    """``(form, n)`` by falling count, then form; forms counted fewer than ``least`` times are left out."""
    write_tsv(df.where(F.col("n") >= least), path, ["form", "n"], [F.col("n").desc(), F.col("form")])


def write_consensus(df: DataFrame, path: str) -> None:
    """Two judges' scores and the verdict, by key."""
    columns = ["key", "headword", "gloss", "source", "a", "b", "verdict"]
    write_tsv(df, path, columns, ["key"], ["\t".join(columns)])


def write_targets(df: DataFrame, path: str) -> None:
    """Frequent forms whose glosses look wrong, the most frequent first."""
    columns = ["freq", "form", "gloss", "flags"]
    write_tsv(df, path, columns, [F.col("freq").desc(), F.col("form").desc()], ["\t".join(columns)])


def write_lemma_map(df: DataFrame, path: str) -> None:
    columns = ["form", "lemma", "key", "headword", "gloss", "freq"]
    write_tsv(df, path, columns, [F.col("freq").desc(), F.col("form"), F.col("lemma")], ["\t".join(columns)])


def write_baseline(df: DataFrame, path: str, name: str) -> None:
    """``(key, value)`` sorted by key, with their number in the first line."""
    write_tsv(df, path, ["key", "value"], ["key"], [f"{name}: {df.count()} rows"])


def write_log(df: DataFrame, path: str, key: str = "i", answer: str = "g") -> None:
    """Append results to a log of JSON lines; failures (null answers) are not written, so they come up again."""
    df.where(F.col(answer).isNotNull() & F.col(key).isNotNull()).write.mode("append").json(path)


def write_manifest(df: DataFrame, path: str, most_sources: int = 100_000, **settings: object) -> dict:
    """A JSON file that says what a run was: its settings, a hash of its rows in any order, and the mix of all sources.

    Sources are labels of stages and feeds; more than ``most_sources`` of them are an error, never left out.
    """
    columns = [F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("\0")) for c in sorted(df.columns)]
    row = F.xxhash64(*columns).cast("decimal(38,0)")
    mix = df.withColumn("_row", row).groupBy("source").agg(F.count(F.lit(1)).alias("n"), F.sum("_row").alias("h")).limit(most_sources + 1).collect()
    if len(mix) > most_sources:
        raise ValueError(f"more than {most_sources} sources")
    found = {str(r["source"]): r["n"] for r in sorted(mix, key=lambda r: (-r["n"], str(r["source"])))}
    manifest = {**settings, "rows": sum(found.values()), "content": f"{sum(int(r['h']) for r in mix) % (1 << 64):016x}", "sources": found}
    with open(path, "w", encoding="utf-8") as file:
        json.dump(manifest, file, ensure_ascii=False, indent=1)
    return manifest


def changed_settings(path: str, **settings: object) -> dict[str, tuple[object, object]]:
    """What differs between a manifest and the settings of a run: ``{name: (then, now)}``; empty if there is no manifest."""
    if not os.path.exists(path):
        return {}
    with open(path, encoding="utf-8") as file:
        then = json.load(file)
    return {k: (then[k], v) for k, v in settings.items() if k in then and then[k] != v}


def _csv_lines(df: DataFrame) -> DataFrame:
    """Rows as lines of CSV: cells are quoted only where they hold a comma, a quote or a line break; real numbers have two places."""
    cells = []
    for name, kind in df.dtypes:
        text = F.format_string("%.2f", F.col(f"`{name}`")) if kind in ("double", "float") else F.col(f"`{name}`").cast("string")
        quoted = F.concat(F.lit('"'), F.replace(text, F.lit('"'), F.lit('""')), F.lit('"'))
        cells.append(F.when(F.col(f"`{name}`").isNull(), "").when(text.rlike('[",\r\n]'), quoted).otherwise(text))
    return df.select(F.concat_ws(",", *cells).alias("value"))


def write_package(path: str, members: dict[str, tuple[DataFrame, list[str]]]) -> dict[str, int]:
    """A ZIP of sorted CSV files ``{name: (rows, order)}`` with fixed time stamps: the same data give the same bytes.

    Rows are sorted and written by the cluster; their part files are then streamed into the archive in order, a
    buffer at a time, so the driver never holds a member. ``path`` may lie on any file system that Spark reaches.
    """
    spark: SparkSession = next(iter(members.values()))[0].sparkSession
    jvm = spark.sparkContext._jvm
    fs, target = hadoop_path(spark, path if "://" in path or path.startswith("file:") else f"file://{os.path.abspath(path)}")
    archive = jvm.java.util.zip.ZipOutputStream(fs.create(target, True))
    counts = {}
    try:
        for name, (df, order) in members.items():
            parts, seen = new_path(spark, "member"), Observation()
            _csv_lines(df.orderBy(*order).observe(seen, F.count(F.lit(1)).alias("n"))).write.text(parts)
            counts[name] = seen.get["n"]
            entry = jvm.java.util.zip.ZipEntry(name)
            entry.setTimeLocal(jvm.java.time.LocalDateTime.of(1980, 1, 1, 0, 0))
            archive.putNextEntry(entry)
            header = ",".join(df.columns) + "\n"
            archive.write(bytearray(header.encode("utf-8")))
            source, folder = hadoop_path(spark, parts)
            for file in sorted((s.getPath() for s in source.listStatus(folder) if s.getPath().getName().startswith("part-")), key=lambda p: p.getName()):
                stream = source.open(file)
                try:
                    jvm.org.apache.hadoop.io.IOUtils.copyBytes(stream, archive, 1 << 16, False)
                finally:
                    stream.close()
            archive.closeEntry()
    finally:
        archive.close()
    return counts


def rewrite_tsv(spark: SparkSession, path: str, columns: list[str], change: Callable[[DataFrame], DataFrame], out: str, dry_run: bool = False) -> DataFrame:
    """Rewrite one column's cells of a positional TSV: comments, other cells and the order of lines stay.

    ``change`` takes the rows as named ``columns`` and returns them with changed cells, row by row. Lines with fewer
    cells stay as they are. The result goes to ``out``, a new folder, which then takes the old one's place; with
    ``dry_run`` nothing is written. Returns the lines that change: ``(line, new)``.
    """
    lines = _lines(spark, path).withColumn("_f", F.split("line", "\t"))
    at = ["path", "line_no", "line", "_f"]
    rows = lines.where(~F.col("line").startswith("#") & (F.size("_f") >= len(columns))).select(*at, *[F.get("_f", F.lit(i)).alias(c) for i, c in enumerate(columns)])
    cells = F.concat(F.array(*[F.coalesce(F.col(c), F.lit("")) for c in columns]), F.slice("_f", len(columns) + 1, F.greatest(F.size("_f") - len(columns), F.lit(0))))
    new = change(rows).select("path", "line_no", "line", F.array_join(cells, "\t").alias("new"))
    if not dry_run:
        same = lines.where(F.col("line").startswith("#") | (F.size("_f") < len(columns))).select("path", "line_no", "line", F.col("line").alias("new"))
        new.unionByName(same).orderBy("path", "line_no").select("new").write.text(out)
    return new.where("line != new").select("line", "new")


# The rules by which readers of a package bring spellings together (language, pattern, replacement, description, priority).
PACKAGE_RULES = [
    ("latin", "[āăá]", "a", "fold long/short a", 10),
    ("latin", "[ēĕé]", "e", "fold long/short e", 10),
    ("latin", "[īĭí]", "i", "fold long/short i", 10),
    ("latin", "[ōŏó]", "o", "fold long/short o", 10),
    ("latin", "[ūŭú]", "u", "fold long/short u", 10),
    ("latin", "[ȳy̆ý]", "y", "fold long/short y", 10),
    ("latin", "j", "i", "fold j to i", 20),
    ("latin", "v", "u", "fold v to u", 20),
]
