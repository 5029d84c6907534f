"""Deterministic hashing: record fingerprints, seeded sampling, labels.

All of them depend only on row values, never on partitioning, so a re-run or
a retried task selects exactly the same rows.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def record_hash(*cols: Column) -> Column:
    """md5 over '|'-joined text; NULL parts are skipped (so (a,NULL,b) == (a,b))."""
    return F.md5(F.concat_ws("|", *[c.cast("string") for c in cols]))


def hash_bucket(seed: int, *cols: Column, buckets: int = 10000) -> Column:
    """Stable bucket in [0, buckets) from the text of ``cols`` and a seed: md5's first 32 bits, which any SQL engine can follow."""
    digest = F.md5(F.concat_ws("|", F.lit(str(seed)), *[c.cast("string") for c in cols]))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("long") % F.lit(buckets)


def seeded_fraction(fraction: float, seed: int, *cols: Column) -> Column:
    """Boolean: row falls in a seeded ``fraction`` sample (same rows on any partitioning)."""
    return hash_bucket(seed, *cols) < F.lit(int(round(fraction * 10000)))


def pick_label(labels: list[str], index: Column) -> Column:
    """Label at ``index`` (0-based, taken modulo the list length)."""
    arr = F.array(*[F.lit(x) for x in labels])
    return F.element_at(arr, (F.pmod(index, F.lit(len(labels))) + 1).cast("int"))


def hash60(*cols: Column) -> Column:
    """The first 60 bits of md5 of the '|'-joined text as a long (any SQL engine can follow); NULL parts are marked, not skipped."""
    parts = [F.coalesce(c.cast("string"), F.lit("\\N")) for c in cols]
    return F.conv(F.substring(F.md5(F.concat_ws("|", *parts)), 1, 15), 16, 10).cast("long")
