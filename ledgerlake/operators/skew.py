"""Heavy keys: found by a sketch, joined where their rows lie, stored in slices (JO1, SK3).

A key is heavy if it holds more rows than one of ``parts`` tasks should get. There are at most
``parts`` such keys, so their list and their lookup rows have a proven bound however large the table is.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake.functions.text import col

SLICE = "_slice"


@dataclass
class HeavyKeys:
    """Rows of the table, rows without a key, and the heavy keys with (at least) their number of rows."""

    key: str
    parts: int
    rows: int = 0
    null_rows: int = 0
    keys: dict = field(default_factory=dict)

    @property
    def fair(self) -> float:
        """The rows of a task if all tasks got the same."""
        return max(self.rows / self.parts, 1.0)

    def __bool__(self) -> bool:
        return bool(self.keys) or self.null_rows > self.fair

    def hit(self) -> Column:
        """Rows that an ordinary shuffle would send to one task: heavy keys and rows without a key."""
        heavy = col(self.key).isin(list(self.keys)) if self.keys else F.lit(False)
        return F.coalesce(heavy, F.lit(True))

    def slices(self, columns: list[str]) -> Column:
        """0 for ordinary rows; rows of a heavy key are dealt by a hash of all their columns into 1..k, about half a fair share each.

        Rows equal in all columns share a slice.
        """
        by_count: dict[int, list] = {}
        for k, n in self.keys.items():
            by_count.setdefault(1 << max(1, math.ceil(math.log2(2 * n / self.fair))), []).append(k)
        salt = F.xxhash64(*[col(c) for c in columns])
        out = F.lit(0)
        for count, keys in sorted(by_count.items()):
            out = F.when(col(self.key).isin(keys), (F.pmod(salt, F.lit(count)) + 1).cast("int")).otherwise(out)
        if self.null_rows > self.fair:
            count = 1 << max(1, math.ceil(math.log2(2 * self.null_rows / self.fair)))
            out = F.when(col(self.key).isNull(), (F.pmod(salt, F.lit(count)) + 1).cast("int")).otherwise(out)
        return out


def heavy_keys(df: DataFrame, key: str, parts: int) -> HeavyKeys:
    """The keys of more than ``rows / parts`` rows, by one scan of the key column.

    Each task keeps a frequent-items sketch of bounded size; it never misses a heavy key, and
    a key that it overrates is only treated as heavy too.
    """
    parts = max(2, parts)
    name = key.replace("`", "``")
    got = df.select(col(key)).agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(col(key).isNull()).alias("nulls"),
        F.expr(f"approx_top_k(`{name}`, {2 * parts}, {8 * parts})").alias("top"),
    ).first()
    out = HeavyKeys(key, parts, got["rows"], got["nulls"])
    out.keys = {t["item"]: t["count"] for t in got["top"] or [] if t["item"] is not None and t["count"] > out.fair}
    return out


def left_lookup(left: DataFrame, right: DataFrame, heavy: HeavyKeys, watch: Callable[[DataFrame], DataFrame] = lambda df: df) -> DataFrame:
    """``left`` LEFT JOIN ``right`` (one row a key) on the heavy keys' column.

    Rows of heavy keys and rows without a key stay where they lie: the heavy keys' rows of
    ``right``, at most one each, are broadcast to them. All others meet in an ordinary join, now
    without a hot key. ``watch`` is applied to the rows of ``left`` that go into either.
    """
    if not heavy:
        return watch(left).join(right, on=heavy.key, how="left")
    hit = heavy.hit()
    some = right.filter(col(heavy.key).isin(list(heavy.keys)))
    here = watch(left.filter(hit)).join(F.broadcast(some), on=heavy.key, how="left")
    return here.unionByName(watch(left.filter(~hit)).join(right, on=heavy.key, how="left"))


def with_slices(df: DataFrame, heavy: HeavyKeys, name: str = SLICE) -> DataFrame:
    """Adds the slice of each row where some key is heavy; a layout by (key, slice) spreads such a key."""
    return df.withColumn(name, heavy.slices([c for c in df.columns if not c.startswith("_")])) if heavy else df
