"""Session helpers.

Library code never changes global session state; it only reads it (one setting,
which frees a write's shuffle files, holds for the write and is set back). The
builder here is for tests, the bench and local runs: it keeps ANSI mode on
(parsing goes through ``try_*`` functions), pins UTC, enables AQE and keeps
the Spark UI off.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, NullType, StructField, StructType


def build_session(master: str | None = None, shuffle_partitions: int = 8, app: str = "ledgerlake") -> SparkSession:
    master = master or f"local[{os.environ.get('BENCH_CPUS', '8')}]"
    return (
        SparkSession.builder.master(master)
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.ansi.enabled", "true")
        .config("spark.driver.memory", os.environ.get("LEDGERLAKE_DRIVER_MEMORY", "16g"))
        .getOrCreate()
    )


def shared_dir(spark: SparkSession) -> str:
    """The cluster-shared folder for lineage cuts and intermediate tables.

    Read from ``spark.checkpoint.dir``; only when it is unset AND the master
    is local (tests, local runs) a fresh scratch folder is created and
    registered. On a cluster an unset folder is an error.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    current = spark.sparkContext.getCheckpointDir()
    if path:
        if not current:
            spark.sparkContext.setCheckpointDir(path)
        return path.rstrip("/")
    if current:
        return current.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        # a machine-local folder is not shared between executors
        raise RuntimeError("set spark.checkpoint.dir to a folder on shared storage")
    path = tempfile.mkdtemp(prefix="ledgerlake-ckpt-")
    spark.sparkContext.setCheckpointDir(path)
    return path


CUT = "ledgerlake-cut"  # the folder of stored frames
PART = "__part"  # the column that dealt rows are stored by
PORTIONS, PORTION_ROWS = 8, 1_000_000  # most steps of a job, and the rows from which it is done in one more
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_freed(spark: SparkSession):
    """A write in this block removes its shuffle files as soon as it has ended.

    What it wrote is what later steps read. Otherwise the files lie on the executors' disks until the
    driver happens to collect garbage, while the next steps shuffle again.
    """
    before = spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(CLEANUP, before)


def cut_lineage(df):
    """Materialize ``df`` in the shared checkpoint folder and return the cut frame.

    A reliable checkpoint survives executor loss (unlike a local checkpoint):
    later stages read the written files instead of replaying the upstream plan.
    For marts and slices; tables of rows are better stored in columns (``stored_rows``).
    """
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def _stored_at(df) -> str | None:
    """The folder where ``df`` is stored as Parquet; None, and nothing is stored, if Parquet cannot hold it."""
    spark = df.sparkSession
    names = {c.lower() for c in df.columns}
    if len(names) < max(len(df.columns), 1) or any(isinstance(f.dataType, NullType) for f in df.schema.fields):
        return None
    path = os.path.join(shared_dir(spark), CUT, uuid.uuid4().hex)
    with shuffles_freed(spark):
        df.write.option("compression", "zstd").parquet(path)
    return path


def stored_rows(df):
    """Store ``df`` as Parquet in the shared checkpoint folder and return the stored frame.

    The files survive executor loss (unlike a local checkpoint): later stages read them instead of
    replaying the upstream plan. Columns are compressed, and a later stage reads only those it uses,
    where a checkpoint keeps and reads whole rows. Frames that Parquet cannot hold (a column of type
    void, names that differ in case only) are checkpointed.
    """
    path = _stored_at(df)
    return cut_lineage(df) if path is None else df.sparkSession.read.schema(df.schema).parquet(path)


def stored_parts(parts):
    """Frames of one schema that Parquet can hold, stored one after the other and read as one.

    What is shuffled for a frame is gone before the next is begun.
    """
    paths = [_stored_at(p) for p in parts]
    return parts[0].sparkSession.read.schema(parts[0].schema).parquet(*paths)


@contextmanager
def passing_rows(df):
    """``stored_rows`` (a list: ``stored_parts``) for the block only: its files are removed at the end, when what was made of the rows is stored itself."""
    from ledgerlake.sinks import files

    out = stored_parts(df) if isinstance(df, list) else stored_rows(df)
    try:
        yield out
    finally:
        for path in sorted({os.path.dirname(f) for f in out.inputFiles()}):
            if os.path.basename(os.path.dirname(path)) == CUT:
                files.remove(out.sparkSession, path)


@contextmanager
def dealt_rows(key: str, parts: int, *frames):
    """The frames stored in ``parts`` folders each, by a hash of their key's text, for the block only.

    Gives a list for each part: of each frame the rows of its keys. A frame is read once, however many parts
    are worked on one after the other, and nothing is shuffled to deal it.
    """
    from ledgerlake.sinks import files

    spark = frames[0].sparkSession
    paths = [os.path.join(shared_dir(spark), CUT, uuid.uuid4().hex) for _ in frames]
    deal = F.pmod(F.xxhash64(F.col(f"`{key}`").cast("string")), F.lit(parts)).cast("int")

    def of(i: int) -> list:
        kinds = [StructType([*df.schema.fields, StructField(PART, IntegerType())]) for df in frames]
        return [spark.read.schema(kind).parquet(path).filter(F.col(PART) == i).drop(PART) for kind, path in zip(kinds, paths)]

    try:
        for df, path in zip(frames, paths):
            df.withColumn(PART, deal).write.option("compression", "zstd").partitionBy(PART).parquet(path)
        yield [of(i) for i in range(parts)]
    finally:
        for path in paths:
            files.remove(spark, path)


def portions(rows: int, most: int | None = None) -> int:
    """In how many steps a job over so many rows is done, if its shuffles are not to lie on the disks all at once."""
    return max(1, min(-(-rows // PORTION_ROWS), PORTIONS, *([most] if most is not None else [])))
