"""Scans. Schemas are given or all text, so no file is read to guess types."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lettermill.functions.text import repair_utf8 as _repair
from lettermill.operators.gate import path_endswith
from lettermill.rules import DECISION_COLUMNS, TYPE_ALIASES
from lettermill.sources.local import local_path, read_files

DRUG_COLUMNS = {"Name": "name", "Primary Site": "primary_site", "Category": "category", "Remarks": "remarks"}
SFT_SCHEMA = "instruction string, output string"
XML_NULL = "\ue000"  # stands for null in XML; a private character that no text should hold


def read_csv(spark: SparkSession, path: str, columns: Sequence[str], multi_line: bool = True) -> DataFrame:
    """Named columns of a headed CSV, all as text, quoted fields with line feeds and doubled quotes included.

    A file with line feeds inside fields is read by one task. Give ``multi_line=False`` for files known
    to have none, so that they are split.
    """
    return (spark.read.option("header", True).option("multiLine", multi_line).option("escape", '"')
            .csv(path).select(*[F.col(f"`{c}`") for c in columns]))


def read_decisions(spark: SparkSession, path: str, columns: Sequence[str] = DECISION_COLUMNS,
                   multi_line: bool = True) -> DataFrame:
    return read_csv(spark, path, columns, multi_line)


def read_drugs(spark: SparkSession, path: str, columns: Mapping[str, str] = DRUG_COLUMNS, multi_line: bool = True) -> DataFrame:
    named = read_csv(spark, path, list(columns), multi_line)
    return named.select(*[F.col(f"`{old}`").alias(new) for old, new in columns.items()])


def read_qa(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    return read_csv(spark, path, ["drug", "question", "answer"], multi_line)


def repair_utf8(df: DataFrame, column: str) -> DataFrame:
    """Drop the bytes of a binary column that are not valid UTF-8."""
    return df.withColumn(column, _repair(F.col(column)))


def read_letters(spark: SparkSession, path: str, format: str = "text", suffix: str = "*.txt") -> DataFrame:
    """(path, raw_text): a directory of letter files, or with ``format='parquet'`` a table of them.

    One file per letter costs a task and a listing entry each; a large corpus belongs in a table. Files under folders
    ``path=<name>``, as ``writers.write_letter_files`` lays them out, get that name, any others their own. What it wrote to
    a disk is listed and read by the workers (``local.read_files``).
    """
    if format == "parquet":
        return spark.read.parquet(path).select("path", "raw_text")
    local = local_path(spark, path)
    letters = read_files(spark, local, suffix) if local else None
    if letters is not None:
        return letters
    files = spark.read.option("pathGlobFilter", suffix).option("recursiveFileLookup", False).text(path, wholetext=True)
    name = F.col("path").cast("string") if "path" in files.columns else F.col("_metadata.file_path")
    return files.select(name.alias("path"), F.col("value").alias("raw_text"))


def read_pages(df: DataFrame, suffix: str = ".pdf") -> DataFrame:
    """(pdf, page_no, text) of the pages whose document has the suffix."""
    return path_endswith(df, suffix, "pdf").select("pdf", "page_no", "text")


def read_phrases(spark: SparkSession, paths: Mapping[str, str]) -> DataFrame:
    """(letter_type, phrase): one phrase per line, lowercased; blank lines go."""
    parts = [spark.read.text(path).select(F.lit(TYPE_ALIASES.get(name, name)).alias("letter_type"),
                                          F.lower("value").alias("phrase"))
             for name, path in paths.items()]
    return reduce(DataFrame.unionByName, parts).filter(F.btrim("phrase") != "")


def read_templates(spark: SparkSession, paths: Mapping[str, str]) -> DataFrame:
    """(name, template): one text file each, taken whole."""
    parts = [spark.read.text(path, wholetext=True).select(F.lit(name).alias("name"), F.col("value").alias("template"))
             for name, path in paths.items()]
    return reduce(DataFrame.unionByName, parts)


def read_articles(spark: SparkSession, path: str, schema: str, row_tag: str = "article") -> DataFrame:
    """Articles of XML files, by a given schema; white space round values is part of them, an empty element is ''."""
    return (spark.read.format("xml").option("rowTag", row_tag).option("ignoreSurroundingSpaces", False).option("nullValue", XML_NULL)
            .schema(schema).load(path))


def read_sft(spark: SparkSession, path: str) -> DataFrame:
    """(instruction, output) from JSON lines."""
    return spark.read.schema(SFT_SCHEMA).json(path)
