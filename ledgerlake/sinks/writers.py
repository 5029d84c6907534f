"""Writers (SK1-SK7).

A ``Store`` names where a layer's tables live: managed catalog tables
(``saveAsTable`` into a database, when ``use_catalog``) or parquet folders
under a base path on shared storage (by default the session's
``spark.checkpoint.dir``). Either way a written table is what the next stage
reads, which also cuts the lineage: a lost executor never replays upstream
stages.
"""

from __future__ import annotations

import os
import time
import uuid
from collections.abc import Iterable
from dataclasses import dataclass
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ledgerlake.operators.windows import with_position
from ledgerlake.session import shared_dir, shuffles_freed
from ledgerlake.sinks import files

NOTHING_THERE = {"PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"}  # error conditions of a missing or empty folder
VERSION = "__v"  # between a table's name and the stamp of a version


@dataclass
class Store:
    spark: SparkSession
    base_path: str | None = None
    use_catalog: bool = False
    prefix: str = "sales"
    # buckets for Order-ID-bucketed layers (catalog mode); None = the session's
    # shuffle partitions. Size it to the data: about 1 GB per bucket file.
    buckets: int | None = None

    def __post_init__(self):
        if not self.use_catalog and not self.base_path:
            self.base_path = os.path.join(shared_dir(self.spark), "ledgerlake")

    def database(self, layer: str) -> str:
        return f"{self.prefix}_{layer}"

    def location(self, layer: str, table: str) -> str:
        if self.use_catalog:
            return f"{self.database(layer)}.{table}"
        return f"{self.base_path.rstrip('/')}/{layer}/{table}"

    def create_databases(self, layers=("bronze", "silver", "gold")) -> list[str]:
        """CREATE DATABASE IF NOT EXISTS per layer (SK6); no-op for path stores.

        With a ``base_path`` the databases are placed there (shared storage),
        otherwise in the session's warehouse.
        """
        if not self.use_catalog:
            return []
        for layer in layers:
            where = f" LOCATION '{self.base_path.rstrip('/')}/{self.database(layer)}.db'" if self.base_path else ""
            self.spark.sql(f"CREATE DATABASE IF NOT EXISTS {self.database(layer)}{where}")
        return [self.database(layer) for layer in layers]

    def databases(self) -> list[str]:
        """Names of all databases of the catalog (SK6), of the layers' folders without one."""
        if self.use_catalog:
            return [d.name for d in self.spark.catalog.listDatabases()]
        return files.names(self.spark, self.base_path)

    def use(self, layer: str) -> str:
        """Make the layer's database the session's current one (SK6); the name of the one before."""
        before = self.spark.catalog.currentDatabase()
        if self.use_catalog:
            self.spark.catalog.setCurrentDatabase(self.database(layer))
        return before

    def write(self, df: DataFrame, layer: str, table: str, partition_by: str | None = None,
              bucket_by: tuple[int, list[str]] | None = None, mode: str = "overwrite") -> int:
        """Write a layer table; ``bucket_by=(n, cols)`` applies to catalog tables only
        (path tables keep no bucket metadata)."""
        return write_table(df, self.location(layer, table), partition_by=partition_by, catalog=self.use_catalog,
                           mode=mode, bucket_by=bucket_by if self.use_catalog else None)

    def stage(self, df: DataFrame | Iterable[DataFrame], layer: str, table: str, partition_by: str | None = None,
              bucket_by: tuple[int, list[str]] | None = None) -> tuple[str, int]:
        """Write a new version of a table beside the published one; (version, rows). Nobody reads it before ``publish``.

        Of several frames, which make up the table, each is written when what was shuffled for the one before is gone.
        """
        version = f"{table}{VERSION}{time.time_ns() // 1_000_000:013d}_{uuid.uuid4().hex[:6]}"
        frames = [df] if isinstance(df, DataFrame) else df
        return version, sum(self.write(x, layer, version, partition_by, bucket_by, "append" if i else "overwrite") for i, x in enumerate(frames))

    def publish(self, layer: str, table: str, version: str, keep: int = 1) -> None:
        """Make a staged version the table, by one atomic step, without writing rows again.

        Catalog: the table's name is a view of a version, and the view is replaced. Paths: a
        small file names the version, and a new one is renamed over it. A crash before that
        step leaves the old version readable, one after it the new version. Readers that started
        before it still find their files: the ``keep`` versions before it stay, older and abandoned ones go.
        """
        before = self.published(layer, table)
        if self.use_catalog:
            name = self.location(layer, table)
            if self.spark.catalog.tableExists(name) and self.spark.catalog.getTable(name).tableType != "VIEW":
                old = f"{table}{VERSION}{0:013d}_000000"  # a table from before versions: it becomes one
                self.spark.sql(f"ALTER TABLE {name} RENAME TO {self.location(layer, old)}")
                before = old
            self.spark.sql(f"CREATE OR REPLACE VIEW {name} AS SELECT * FROM {self.location(layer, version)}")
        else:
            files.replace_text(self.spark, self._pointer(layer, table), version)
        others = [v for v in self.versions(layer, table) if v < version and v != before]
        for v in others if keep else [*others, *[b for b in [before] if b]]:
            self.drop(layer, v)

    def _pointer(self, layer: str, table: str) -> str:
        return f"{self.location(layer, table)}.current"

    def published(self, layer: str, table: str) -> str | None:
        """The published version, None if the table has none."""
        if not self.use_catalog:
            return files.read_text(self.spark, self._pointer(layer, table))
        name = self.location(layer, table)
        if not self.spark.catalog.tableExists(name) or self.spark.catalog.getTable(name).tableType != "VIEW":
            return None
        rows = self.spark.sql(f"DESCRIBE TABLE EXTENDED {name}").filter("col_name = 'View Text'").collect()
        return rows[0]["data_type"].rsplit(".", 1)[-1].strip("`") if rows else None

    def versions(self, layer: str, table: str) -> list[str]:
        """All versions, staged ones included, oldest first."""
        head = f"{table}{VERSION}"
        if self.use_catalog:
            found = [t.name for t in self.spark.catalog.listTables(self.database(layer))]
        else:
            found = files.names(self.spark, f"{self.base_path.rstrip('/')}/{layer}")
        return sorted(v for v in found if v.startswith(head))

    def drop(self, layer: str, table: str) -> None:
        if self.use_catalog:
            self.spark.sql(f"DROP TABLE IF EXISTS {self.location(layer, table)}")
        else:
            files.remove(self.spark, self.location(layer, table))

    def read(self, layer: str, table: str) -> DataFrame:
        if self.use_catalog:
            return self.spark.table(self.location(layer, table))
        return self.spark.read.parquet(self._folder(layer, table))

    def _folder(self, layer: str, table: str) -> str:
        return self.location(layer, self.published(layer, table) or table)

    def exists(self, layer: str, table: str) -> bool:
        """Table present (no job: catalog lookup, or the parquet footer read at analysis)."""
        if self.use_catalog:
            return self.spark.catalog.tableExists(self.location(layer, table))
        try:
            self.spark.read.parquet(self._folder(layer, table)).schema
            return True
        except AnalysisException as e:
            if e.getCondition() in NOTHING_THERE:
                return False
            raise


def path_has_files(spark: SparkSession, path: str) -> bool:
    """True when ``path`` exists and holds at least one visible file (no data read)."""
    try:
        return spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path) \
            .select("path").limit(1).count() > 0
    except AnalysisException as e:
        if e.getCondition() in NOTHING_THERE:
            return False
        raise


def balanced_for_write(df: DataFrame, partition_by: str, writers: int | None = None) -> DataFrame:
    """Shuffle rows to (partition value, salt) before a partitioned write.

    Without it every task writes one file per partition value it holds
    (tasks x values small files) and sorts its rows by the partition column.
    With it each task holds one slice of one value: files come out few and
    evenly sized, and a value holding a third of the rows is still spread
    over ``writers`` tasks (the salt is a hash of the whole row).
    """
    spark = df.sparkSession
    n = writers or int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
    salt = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]), F.lit(max(n, 1)))
    return df.repartition(F.col(f"`{partition_by}`"), salt)


def write_table(df: DataFrame, location: str, partition_by: str | None = None, catalog: bool = False,
                mode: str = "overwrite", balance: bool = False, bucket_by: tuple[int, list[str]] | None = None) -> int:
    """Full replace of a parquet table (schema included); returns rows written.

    The row count is observed during the write (an ``Observation``), so the
    table is not read back to count it. ``bucket_by=(n, cols)`` (catalog tables)
    stores the rows hash-bucketed: a later aggregate or join whose keys include
    ``cols`` reads them without a shuffle. ``balance=True`` shuffles a
    partitioned write first (see ``balanced_for_write``): worth it when the
    input's tasks each hold every partition value (many small files); it
    costs one extra shuffle of the table.
    """
    if bucket_by and catalog:
        # one task per bucket: each task writes one file per partition value.
        # Spark drops this exchange when the input is already hash-partitioned
        # on the bucket columns with the same count (e.g. after the dedup).
        n, cols = bucket_by
        df = df.repartition(n, *[F.col(f"`{c}`") for c in cols])
    elif partition_by and balance:
        df = balanced_for_write(df, partition_by)
    obs = Observation("rows")
    observed = df.observe(obs, F.count(F.lit(1)).alias("n"))
    writer = observed.write.format("parquet").mode(mode).option("compression", "zstd")
    if partition_by:
        writer = writer.partitionBy(partition_by)
    if catalog and bucket_by:
        n, cols = bucket_by
        writer = writer.bucketBy(n, *cols)
    with shuffles_freed(df.sparkSession):
        writer.saveAsTable(location) if catalog else writer.save(location)
    return int(obs.get["n"])


def export_csv(df: DataFrame, path: str, single_file: bool = False, compression: str = "none") -> str:
    """CSV with header, overwrite (SK1); ``compression`` is Spark's name of a codec (``gzip``).

    ``single_file`` is the caller's choice, for results known to be small:
    ``repartition(1)`` sends all rows through one task (the stages before it
    stay parallel, unlike with ``coalesce(1)``).
    """
    if single_file:
        df = df.repartition(1)
    df.write.mode("overwrite").option("header", True).option("compression", compression).csv(path)
    return path


POSITION = "_position"


def publish_mart(store: Store, df: DataFrame, name: str, partition_by: str | None = None,
                 created_at: str | None = None, csv_base: str | None = None, order: list[Column] | None = None) -> int:
    """Write a gold mart with ``_gold_table`` / ``_created_at`` and export it as CSV (SK5).

    The CSV is exported from the written table, so the mart's plan runs once. With ``order`` the rows get a
    ``_position`` and are written in its ranges, sorted: the order of the files (within a partition value) and
    of their rows is the order of the rows, in the table and in the CSV.
    """
    ts = F.lit(created_at).cast("timestamp") if created_at else F.current_timestamp()
    gold = df
    if order:
        gold = with_position(df, order, POSITION)
        gold = gold.repartitionByRange(F.col(POSITION)).sortWithinPartitions(*[F.col(f"`{c}`") for c in [partition_by, POSITION] if c])
    gold = gold.withColumns({"_gold_table": F.lit(name), "_created_at": ts})
    n = store.write(gold, "gold", name, partition_by=partition_by)
    if csv_base:
        back = store.read("gold", name)
        export_csv(back.orderBy(POSITION) if order else back, f"{csv_base.rstrip('/')}/{name}")
    return n


def read_mart(store: Store, name: str) -> DataFrame:
    """A mart in the order it was published with."""
    df = store.read("gold", name)
    return df.orderBy(POSITION) if POSITION in df.columns else df


def verify_tables(store: Store, layer: str, names: list[str]) -> DataFrame:
    """(table, exists, rows) per name (SK7); missing tables are tolerated.

    All tables are counted in one job; a count reads no column.
    """
    spark = store.spark
    parts = []
    for i, name in enumerate(names):
        here = store.exists(layer, name)
        n = store.read(layer, name).agg(F.count(F.lit(1)).alias("rows")) if here else spark.range(1).select(F.lit(None).cast("bigint").alias("rows"))
        parts.append(n.select(F.lit(i).alias("place"), F.lit(name).alias("table"), F.lit(here).alias("exists"), "rows"))
    if not parts:
        return spark.createDataFrame([], "table string, exists boolean, rows bigint")
    return reduce(DataFrame.unionAll, parts).orderBy("place").drop("place")
