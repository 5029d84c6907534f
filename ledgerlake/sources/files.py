"""File sources and gates (SC1-SC11).

Reads take an explicit schema (all text by default): schema inference costs a
pass per file and can make yearly files disagree; text is typed later with
``try_cast`` in silver.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType


class MissingColumnsError(ValueError):
    pass


class MissingSourceError(FileNotFoundError):
    pass


def text_schema(columns: list[str]) -> StructType:
    return StructType([StructField(c, StringType()) for c in columns])


def read_csv(spark: SparkSession, path, schema: StructType | None = None, infer: bool = False,
             encoding: str = "UTF-8") -> DataFrame:
    """Header CSV (SC1/SC2). Without a schema, either all strings or inferred (opt-in)."""
    r = spark.read.option("header", True).option("encoding", encoding)
    if schema is not None:
        r = r.schema(schema).option("enforceSchema", False)
    elif infer:
        r = r.option("inferSchema", True)
    df = r.csv(path)
    return strip_column_names(df)


def strip_column_names(df: DataFrame) -> DataFrame:
    stripped = [c.strip() for c in df.columns]
    return df if stripped == df.columns else df.toDF(*stripped)


def read_csv_any_encoding(spark: SparkSession, path, schema: StructType | None = None,
                          encodings=("UTF-8", "ISO-8859-1")) -> tuple[DataFrame, str]:
    """Read with the first encoding that decodes cleanly (SC7).

    Spark does not fail on bad bytes; it substitutes U+FFFD. One counting job
    per attempt looks for that character in any text column; ISO-8859-1
    decodes every byte, so it is the last resort.
    """
    last = None
    for enc in encodings:
        df = read_csv(spark, path, schema=schema, encoding=enc)
        texts = [f.name for f in df.schema.fields if isinstance(f.dataType, StringType)]
        if not texts or enc == encodings[-1]:
            return df, enc
        joined = F.concat_ws("\u0001", *[F.col(f"`{c}`") for c in texts])
        bad = df.agg(F.count_if(F.contains(joined, F.lit("�"))).alias("n")).first()["n"]
        if bad == 0:
            return df, enc
        last = df
    return last, encodings[-1]


def read_parquet(spark: SparkSession, path) -> DataFrame:
    """Parquet scan (SC3); filters and projections reach the scan."""
    return spark.read.parquet(path)


def read_table(spark: SparkSession, name: str) -> DataFrame:
    """Catalog table scan (SC4)."""
    return spark.table(name)


def missing_columns(df: DataFrame, required: list[str]) -> list[str]:
    """Required columns absent from ``df`` (SC9/SO4), decided from the schema, no job."""
    have = set(df.columns)
    return [c for c in required if c not in have]


def require_columns(df: DataFrame, required: list[str], context: str = "") -> DataFrame:
    """Raise naming the missing columns (SC8)."""
    miss = missing_columns(df, required)
    if miss:
        raise MissingColumnsError(f"{context} missing mandatory columns: {miss}".strip())
    return df


def require_sources(spark: SparkSession, paths: list[str]) -> None:
    """Raise if any source folder is missing or holds no visible file (SC10)."""
    from ledgerlake.sinks.writers import path_has_files

    missing = [p for p in paths if not path_has_files(spark, p)]
    if missing:
        raise MissingSourceError(f"Some source files missing: {missing}")


def yearly_folders(spark: SparkSession, paths: list[str]) -> list[str]:
    """The folders (or files) that the paths, which may hold wildcards, stand for."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    out = []
    for path in paths:
        p = jvm.org.apache.hadoop.fs.Path(path)
        found = p.getFileSystem(conf).globStatus(p) or []
        out += [f.getPath().toString() for f in found if not f.getPath().getName().startswith(("_", "."))]
    return sorted(set(out))


def read_yearly(spark: SparkSession, paths: list[str], schema: StructType, required: list[str] | None = None) -> DataFrame:
    """All yearly folders by column NAME, tagged with Source_Year / Source_File from the path (SC5, Q13).

    Each folder's header is read: a folder that lacks a ``required`` column raises and is named, other
    columns of ``schema`` that it lacks become NULL, columns unknown to the schema are left out. Folders
    with one header are one scan; a file whose header differs from its folder's raises
    (``enforceSchema`` is off). The year comes from the folder name (``sales_2019/part-...``): the path
    wins over any year column inside the file.
    """
    by_header: dict[tuple[str, ...], list[str]] = {}
    for folder in yearly_folders(spark, paths):
        header = tuple(spark.read.option("header", True).csv(folder).columns)
        miss = [c for c in required or [] if c not in {h.strip() for h in header}]
        if miss:
            raise MissingColumnsError(f"{folder} missing mandatory columns: {miss}")
        by_header.setdefault(header, []).append(folder)
    if not by_header:
        raise MissingSourceError(f"Some source files missing: {paths}")
    kinds = {f.name: f.dataType for f in schema.fields}
    # by plain cuts at '/': a pattern searched in the whole path of every row costs more than parsing the row
    folder = F.substring_index(F.substring_index(F.col("_metadata.file_path"), "/", -2), "/", 1)
    year = F.regexp_extract(F.right(folder, F.lit(4)), r"^(\d{4})$", 1)
    frames = []
    for header, folders in by_header.items():
        own = StructType([StructField(h, kinds.get(h.strip(), StringType())) for h in header])
        df = spark.read.option("header", True).option("enforceSchema", False).schema(own).csv(folders)
        df = df.withColumns({"__year": F.when(year != "", year.cast("int")), "__file": folder})
        here = {h.strip(): h for h in header}
        columns = [F.col(f"`{here[c]}`").alias(c) if c in here else F.lit(None).cast(t).alias(c) for c, t in kinds.items()]
        columns = [c for c, name in zip(columns, kinds) if name not in ("Source_Year", "Source_File")]
        frames.append(df.select(*columns, F.col("__year").alias("Source_Year"), F.col("__file").alias("Source_File")))
    return union_by_name(frames)


def union_by_name(frames: list[DataFrame]) -> DataFrame:
    """UNION ALL by column name; a column missing from a frame becomes NULL (SO1)."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def shape(df: DataFrame) -> DataFrame:
    """Row count, column count and schema text, one row (SC11)."""
    return df.agg(F.count(F.lit(1)).alias("rows")).withColumns(
        {"columns": F.lit(len(df.columns)), "schema": F.lit(df.schema.simpleString())}
    )
