"""Landing job: raw CSV files of mixed encodings -> one typed-as-text table, stored as parquet and CSV (SC7, SC9).

The encoding is decided for each file: one job checks the bytes of all lines for valid UTF-8. Files are
then read in one scan per (encoding, header) and united by column name.
"""

from __future__ import annotations

import csv
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.sinks import files as storage
from ledgerlake.sinks.writers import export_csv, write_table
from ledgerlake.sources.files import MissingSourceError, missing_columns, text_schema, union_by_name

UTF8, FALLBACK = "UTF-8", "ISO-8859-1"
FILE, ENCODING = "_file", "_encoding"


@dataclass
class Landed:
    """What was stored where: rows, files by encoding, files with bad UTF-8, and the listed columns that no file has."""

    parquet: str
    csv: str
    rows: int
    encodings: dict[str, int] = field(default_factory=dict)
    bad_files: list[str] = field(default_factory=list)
    missing: list[str] = field(default_factory=list)


def file_encodings(spark: SparkSession, paths: list[str], fallback: str = FALLBACK) -> DataFrame:
    """(path, encoding, lines, bad_lines) of each file: UTF-8 if every line's bytes are valid, else ``fallback``.

    Lines are checked as raw bytes inside the scan (no character spans a line end), so large files
    are checked by many tasks; per file only two counts are shuffled. Files without a line do not appear.
    """
    lines = spark.read.text(paths).select(F.col("_metadata.file_path").alias("path"), F.is_valid_utf8("value").alias("fine"))
    per = lines.groupBy("path").agg(F.count(F.lit(1)).alias("lines"), F.count_if(~F.col("fine")).alias("bad_lines"))
    return per.select("path", F.when(F.col("bad_lines") == 0, UTF8).otherwise(fallback).alias("encoding"), "lines", "bad_lines")


def header(spark: SparkSession, path: str, encoding: str) -> tuple[str, ...]:
    """The column names in the first line of a file; only that line is read."""
    line = storage.first_line(spark, path).decode(encoding, "replace").removeprefix("﻿")
    return tuple(next(csv.reader([line]), []))


def read_mixed(spark: SparkSession, paths: list[str], fallback: str = FALLBACK) -> tuple[DataFrame, list]:
    """(all rows as text with their file and encoding, the rows of ``file_encodings``).

    Names are trimmed and matched by name: a column that a file lacks is NULL there.
    """
    kinds = sorted(file_encodings(spark, paths, fallback).collect(), key=lambda r: r["path"])  # a row per input file, as the file listing
    if not kinds:
        raise MissingSourceError(f"Some source files missing: {paths}")
    groups: dict[tuple, list[str]] = {}
    for r in kinds:
        groups.setdefault((r["encoding"], header(spark, r["path"], r["encoding"])), []).append(r["path"])
    frames = []
    for (encoding, names), members in groups.items():
        df = spark.read.option("header", True).option("enforceSchema", True).option("encoding", encoding).schema(text_schema(list(names))).csv(members)
        path = F.col("_metadata.file_path")
        frames.append(df.select(*[F.col(f"`{c}`").alias(c.strip()) for c in names], path.alias(FILE), F.lit(encoding).alias(ENCODING)))
    return union_by_name(frames), kinds


def land_csv(spark: SparkSession, paths: list[str], out: str, required: list[str] | None = None, fallback: str = FALLBACK) -> Landed:
    """Read the files, report the columns that are missing (no failure), write ``out/parquet`` and from it ``out/csv``."""
    df, kinds = read_mixed(spark, paths, fallback)
    rows = write_table(df, f"{out.rstrip('/')}/parquet")
    stored = spark.read.parquet(f"{out.rstrip('/')}/parquet")
    export_csv(stored.drop(FILE, ENCODING), f"{out.rstrip('/')}/csv")
    by: dict[str, int] = {}
    for r in kinds:
        by[r["encoding"]] = by.get(r["encoding"], 0) + 1
    return Landed(f"{out.rstrip('/')}/parquet", f"{out.rstrip('/')}/csv", rows, by, [r["path"] for r in kinds if r["bad_lines"]], missing_columns(df, required or []))
