"""Readers of the text formats that lexical projects keep their data in.

All readers are lazy DataFrames. Where an order matters it is an explicit column: where a line stands, or the
position of a block in its file, never the order of rows. Text files are read by line, so a large one is
split over many tasks; ``line_no`` is then where the split begins and the line's turn in it, which orders
the lines of a file without a second pass over it.
"""

from __future__ import annotations

import os

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from glossaria.functions.normalize import fold
from glossaria.functions.text import collapse_space, strip_tags


LINE_NO = "struct<block bigint, row bigint>"


def _lines(spark: SparkSession, path: str, missing_ok: bool = False) -> DataFrame:
    """``(path, written, line_no, line)`` of the lines that aren't empty; with ``missing_ok`` a path that isn't there has none."""
    try:
        files = spark.read.text(path)
    except AnalysisException as missing:
        if not missing_ok or missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], f"path string, written timestamp, line_no {LINE_NO}, line string")
    m = F.col("_metadata")
    line_no = F.struct(m["file_block_start"].alias("block"), F.monotonically_increasing_id().alias("row"))
    return files.select(m["file_path"].alias("path"), m["file_modification_time"].alias("written"), line_no.alias("line_no"), F.col("value").alias("line")).where("line != ''")


def read_tsv(spark: SparkSession, path: str, columns: list[str], least: int | None = None, missing_ok: bool = False) -> DataFrame:
    """Tab-separated lines without a header: # begins a comment, lines of fewer than ``least`` fields are dropped.

    Missing trailing fields are null; fields beyond the named ones are ignored. ``path`` and ``line_no`` say where a row stood.
    """
    rows = _lines(spark, path, missing_ok).where(~F.col("line").startswith("#")).withColumn("f", F.split("line", "\t"))
    rows = rows.where(F.size("f") >= (least if least is not None else len(columns)))
    return rows.select("path", "line_no", *[F.get("f", F.lit(i)).alias(c) for i, c in enumerate(columns)])


def read_frequencies(spark: SparkSession, path: str) -> DataFrame:
    """``(form, n)``: a frequency list; lines whose count is no number are dropped, forms folded and those that fold alike summed."""
    rows = read_ranked(spark, path)
    return rows.groupBy(fold(F.col("form")).alias("form")).agg(F.sum("n").alias("n")).where("form != ''")


def read_ranked(spark: SparkSession, path: str) -> DataFrame:
    """``(path, line_no, form, n)``: a frequency list as it stands; ``line_no`` is its order."""
    rows = read_tsv(spark, path, ["form", "n"]).where("n rlike '^[0-9]+$' and form != ''")
    return rows.select("path", "line_no", "form", F.col("n").cast("bigint").alias("n"))


def read_lemma_map(spark: SparkSession, path: str) -> DataFrame:
    """``(form, lemma, key, headword, gloss, freq)`` of a lemma map; a map that isn't there has no rows."""
    rows = read_tsv(spark, path, ["form", "lemma", "key", "headword", "gloss", "freq"], least=2, missing_ok=True)
    return rows.withColumn("freq", F.expr("try_cast(freq as bigint)")).drop("path", "line_no")


def read_gold(spark: SparkSession, path: str) -> DataFrame:
    """``(key, gold)``: the expected answers of an evaluation; the last line of a key counts."""
    rows = read_tsv(spark, path, ["key", "gold"])
    return rows.groupBy("key").agg(F.max_by("gold", F.struct("path", "line_no")).alias("gold"))


def read_baseline(spark: SparkSession, path: str) -> DataFrame:
    """``(key, value)``: all after the first tab is the value, further tabs included; no file, no rows."""
    rows = _lines(spark, path, missing_ok=True).where(~F.col("line").startswith("#"))
    at = F.locate("\t", F.col("line"))
    key = F.when(at > 0, F.substring("line", F.lit(1), at - 1)).otherwise(F.col("line"))
    value = F.when(at > 0, F.substring("line", at + 1, F.length("line"))).otherwise("")
    return rows.select(key.alias("key"), value.alias("value"), "path", "line_no").groupBy("key").agg(F.max_by("value", F.struct("path", "line_no")).alias("value"))


def read_prompt(spark: SparkSession, path: str) -> str:
    """A text file of instructions, without the white space around it; any file system that Spark reads."""
    rows = spark.read.text(path, wholetext=True).limit(2).collect()
    if len(rows) != 1:
        raise ValueError(f"{path} is no single file")
    return rows[0][0].strip()


def resolve(path: str, *roots: str) -> str:
    """The path as it is if absolute or a URI; else below the first of the working folder and ``roots`` that has it."""
    if os.path.isabs(path) or "://" in path:
        return path
    return next((found for root in (os.getcwd(), *roots) if os.path.exists(found := os.path.join(root, path))), path)


def read_scores(spark: SparkSession, path: str) -> DataFrame:
    """``(key, headword, gloss, source, score, reason)``: the last line of a key counts; scores that are no numbers are dropped."""
    names = ["key", "headword", "gloss", "source", "score", "reason"]
    rows = read_tsv(spark, path, names, least=5).withColumn("score", F.expr("try_cast(score as int)")).where("score is not null")
    last = F.max_by(F.struct(*names[1:]), F.struct("path", "line_no"))
    return rows.groupBy("key").agg(last.alias("v")).select("key", "v.*")


def read_blocks(spark: SparkSession, path: str, tag: str) -> DataFrame:
    """``(path, pos, xml)``: the elements of one tag in document order; elements of the same tag don't nest."""
    files = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("path"), "value")
    return files.select("path", F.posexplode(F.regexp_extract_all("value", F.lit(rf"(?s)<{tag}\b.*?</{tag}>"), F.lit(0))).alias("pos", "xml"))


def attribute(xml: Column, name: str) -> Column:
    """An attribute of the first tag, or null."""
    return F.nullif(F.regexp_extract(xml, rf'^<[^>]*\b{name}="([^"]*)"', 1), F.lit(""))


def element(xml: Column, tag: str) -> Column:
    """The text of the first element of a tag, or null."""
    return F.nullif(strip_tags(F.regexp_extract(xml, rf"(?s)<{tag}\b[^>]*>(.*?)</{tag}>", 1)), F.lit(""))


def elements(xml: Column, tag: str) -> Column:
    """The texts of all elements of a tag."""
    return F.transform(F.regexp_extract_all(xml, F.lit(rf"(?s)<{tag}\b[^>]*>(.*?)</{tag}>"), F.lit(1)), lambda x: strip_tags(x))


def read_dictionary(spark: SparkSession, path: str, tag: str = "entryFree") -> DataFrame:
    """``(path, pos, key, headword, translations, body)`` of dictionary articles; an article without <orth> is headed by its key."""
    blocks = read_blocks(spark, path, tag)
    return blocks.select("path", "pos", attribute(F.col("xml"), "key").alias("key"), F.coalesce(element(F.col("xml"), "orth"), attribute(F.col("xml"), "key")).alias("headword"), elements(F.col("xml"), "tr").alias("translations"), strip_tags(F.col("xml")).alias("body"))


# Editorial elements whose content is no text of the author.
EDITORIAL_TAGS = "note bibl head speaker ref figure orig del".split()


def read_corpus(spark: SparkSession, path: str, name: str = r"-lat\d*\.xml$") -> DataFrame:
    """``(path, text)`` of the texts of a folder and its subfolders whose file name fits ``name``.

    The header is cut off by position and editorial elements one tag at a time: one pattern for all with a
    back reference would be quadratic.
    """
    files = spark.read.option("recursiveFileLookup", "true").text(path, wholetext=True).select(F.col("_metadata.file_path").alias("path"), "value").where(F.col("path").rlike(name))
    at = F.locate("</teiHeader>", F.col("value"))
    text = F.when(at > 0, F.substring("value", at + len("</teiHeader>"), F.length("value"))).otherwise(F.col("value"))
    for tag in EDITORIAL_TAGS:
        text = F.regexp_replace(text, rf"(?s)<{tag}\b[^>]*>.*?</{tag}>", " ")
    return files.select("path", collapse_space(F.regexp_replace(text, "<[^>]+>", " ")).alias("text"))


def read_treebank(spark: SparkSession, path: str) -> DataFrame:
    """``(path, pos, form, lemma, postag)`` of the <word> elements of treebank files; incomplete ones are dropped, lemmas lose their number."""
    files = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("path"), "value")
    words = files.select("path", F.posexplode(F.regexp_extract_all("value", F.lit(r"<word\b[^>]*>"), F.lit(0))).alias("pos", "w"))
    rows = words.select("path", "pos", *[attribute(F.col("w"), a).alias(a) for a in ("form", "lemma", "postag")]).dropna(subset=["form", "lemma", "postag"])
    return rows.withColumn("lemma", F.regexp_replace("lemma", "[0-9]+$", ""))


LOG_SCHEMA = "i bigint, w string, p string, g string, s int, `in` string, off int, l string, why string, kept boolean"


def read_log(spark: SparkSession, path: str, one_pass: str | None = None, key: str = "i") -> DataFrame:
    """The latest record per key of a log of JSON lines, files in the order they were written; malformed lines are dropped, a line without pass is of the main one."""
    lines = _lines(spark, path)
    rows = lines.select("written", "path", "line_no", F.from_json("line", LOG_SCHEMA, {"mode": "PERMISSIVE"}).alias("r")).select("written", "path", "line_no", "r.*").where(F.col(key).isNotNull())
    rows = rows.withColumn("p", F.coalesce("p", F.lit("main")))
    if one_pass:
        rows = rows.where(F.col("p") == one_pass)
    values = [F.col(f"`{c}`") for c in rows.columns if c not in (key, "written", "path", "line_no")]
    return rows.groupBy(key).agg(F.max_by(F.struct(*values), F.struct("written", "path", "line_no")).alias("v")).select(key, "v.*")


def read_replies(spark: SparkSession, path: str) -> DataFrame:
    """``(key, reply)`` of a log: the last reply per pass and article, keyed ``pass:article``, white space collapsed; empty ones never count."""
    log = _lines(spark, path, missing_ok=True).select("written", "path", "line_no", F.from_json("line", LOG_SCHEMA, {"mode": "PERMISSIVE"}).alias("r"))
    reply = collapse_space(F.col("r.g"))
    rows = log.where(F.col("r.i").isNotNull() & (reply != "")).select(F.concat(F.coalesce("r.p", F.lit("main")), F.lit(":"), "r.i").alias("key"), reply.alias("reply"), F.struct("written", "path", "line_no").alias("at"))
    return rows.groupBy("key").agg(F.max_by("reply", "at").alias("reply"))


def read_zip_csv(spark: SparkSession, path: str, member: str) -> DataFrame:
    """``(path, line_no, fields)``: the rows of a CSV file inside ZIP archives, as maps by the header's names."""
    import csv
    import io
    import zipfile
    from collections.abc import Iterator

    import pandas as pd

    def unpack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for file, content in zip(batch["path"], batch["content"], strict=True):
                with zipfile.ZipFile(io.BytesIO(content)) as archive, archive.open(member) as raw:
                    rows = []
                    for k, row in enumerate(csv.DictReader(io.TextIOWrapper(raw, "utf-8", newline=""))):
                        rows.append((file, k, row))
                        if len(rows) == 10_000:
                            yield pd.DataFrame(rows, columns=["path", "line_no", "fields"])
                            rows = []
                    yield pd.DataFrame(rows, columns=["path", "line_no", "fields"])

    files = spark.read.format("binaryFile").load(path).select("path", "content")
    return files.mapInPandas(unpack, "path string, line_no bigint, fields map<string,string>")
