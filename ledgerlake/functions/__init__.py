"""Column-expression helpers (JVM-side, codegen friendly; no Python UDFs)."""

from ledgerlake.functions.buckets import discount_bucket
from ledgerlake.functions.dates import parse_date
from ledgerlake.functions.hashing import hash_bucket, pick_label, record_hash, seeded_fraction
from ledgerlake.functions.numeric import (
    clamp,
    exact_avg,
    pct,
    round_money_sum,
)
from ledgerlake.functions.text import col, title_case

__all__ = [
    "clamp",
    "col",
    "discount_bucket",
    "exact_avg",
    "hash_bucket",
    "parse_date",
    "pct",
    "pick_label",
    "record_hash",
    "round_money_sum",
    "seeded_fraction",
    "title_case",
]
