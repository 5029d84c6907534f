"""Document fingerprints by context-triggered piecewise hashing.

A hash of the last seven bytes rolls over the text and triggers the end of a chunk wherever it is one
less than a multiple of the block size. Every chunk gives one character (six bits of its hash), so an
edit changes the characters beside it only. Block sizes are 3, 6, 12, ...; a text takes the largest
(from that which would give 64 chunks) which still gives 32, and has a second signature at twice
that size, so that texts of different sizes can be compared. Every chunk has its character, however
many there are: texts that repeat themselves have longer signatures, not cut ones. The largest size
goes by the length of the text alone, so that a text and its edit have a size in common. Likeness is one less the share of
insertions and deletions that turn one signature into the other. Two signatures of eight characters and
more that are less than 0.9 alike and share no four characters in a row are alike by chance only: 0.
"""

from __future__ import annotations

import hashlib
from os.path import commonprefix

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.llm.common import blocks, documents, hash_ranges, map_arrow, mixed, offsets, row_blocks, text_bytes

ROLL, LEAST, WORD = 7, 32, 64
# fixed value: the characters of base 64 in their order
LETTERS = np.frombuffer(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/", np.uint8)
CODES = np.full(256, -1, np.int64)
CODES[LETTERS] = np.arange(64)
_TABLES = mixed(np.arange(1, ROLL * 256 + 1, dtype=np.uint64)).reshape(ROLL, 256) & np.uint64(0xFFFFFFFF)


def _levels(data: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """For each byte the largest j such that a chunk of block size 3 * 2**j ends with it; -1: none."""
    roll = np.zeros(len(data), np.uint64)
    for k in range(ROLL):
        roll[k:] += _TABLES[k][data[: len(data) - k]]
    # the first bytes of a text have no full window: they trigger nothing
    inside = np.arange(len(data)) - np.repeat(edges[:-1], np.diff(edges))
    third, rest = np.divmod(roll + np.uint64(1), np.uint64(3))
    low = third & (~third + np.uint64(1))
    level = np.frexp(low.astype(np.float64))[1] - 1
    return np.where((rest == 0) & (third > 0) & (inside >= ROLL - 1), level, -1)


def fingerprints(data: np.ndarray, edges: np.ndarray) -> list[str]:
    """The fingerprint of each text between the edges: block size, signature, signature at twice the size."""
    out: list[str] = []
    for a, b in row_blocks(edges, 1 << 22):
        piece, cut = data[edges[a] : edges[b]], edges[a : b + 1] - edges[a]
        level = _levels(piece, cut)
        ends = np.flatnonzero(level >= 0)
        level = level[ends]
        at = np.searchsorted(ends, cut)
        sizes = np.diff(cut)
        top = np.maximum(0, np.ceil(np.log2(np.maximum(sizes, 1) / (3 * WORD)))).astype(np.int64)
        # chunk ends by text and level, as sums from the highest level down
        doc = np.repeat(np.arange(len(sizes)), np.diff(at))
        most = int(top.max(initial=0)) + 2
        counts = np.zeros((len(sizes), most), np.int64)
        np.add.at(counts, (doc, np.minimum(level, most - 1)), 1)
        counts = counts[:, ::-1].cumsum(axis=1)[:, ::-1]
        fits = (counts >= LEAST) & (np.arange(most) <= top[:, None])
        j = np.where(fits.any(axis=1), most - 1 - fits[:, ::-1].argmax(axis=1), 0)
        signs = [_signatures(piece, cut, ends, level, doc, j + up) for up in (0, 1)]
        out += [f"{3 << k}:{s}:{t}" for k, s, t in zip(j.tolist(), *signs, strict=True)]
    return out


def _signatures(data, cut, ends, level, doc, j) -> list[str]:
    """One character for each chunk of block size 3 * 2**j; the last one ends with the text."""
    pick = level >= j[doc]
    stop, row = ends[pick] + 1, doc[pick]
    keep = stop < cut[1:][row]
    stop, row = stop[keep], row[keep]
    full = np.flatnonzero(np.diff(cut) > 0)  # the last chunk ends with the text
    stop, row = np.concatenate([stop, cut[1:][full]]), np.concatenate([row, full])
    order = np.lexsort((stop, row))
    stop, row = stop[order], row[order]
    first = np.concatenate([[True], row[1:] != row[:-1]]) if len(row) else np.zeros(0, bool)
    start = np.where(first, cut[:-1][row], np.concatenate([[0], stop[:-1]])[: len(stop)])
    text = LETTERS[(hash_ranges(data, start, stop) >> np.uint64(58)).astype(np.int64)].tobytes().decode()
    at = np.searchsorted(row, np.arange(len(cut)))
    return [text[p:q] for p, q in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]


def _common(a: list[str], b: list[str]) -> np.ndarray:
    """Lengths of the longest common subsequences; pairs of at most 64 characters all at once."""
    out = np.zeros(len(a), np.int64)
    long = np.array([max(len(x), len(y)) > WORD for x, y in zip(a, b, strict=True)], bool)
    rows = np.flatnonzero(~long)
    if len(rows):
        out[rows] = _common_short([a[r] for r in rows], [b[r] for r in rows])
    for r in np.flatnonzero(long):
        out[r] = _common_long(a[r], b[r])
    return out


def _common_long(x: str, y: str) -> int:
    """The same for one pair of any length: what begins and ends both is common, the rest goes by one long word."""
    head = len(commonprefix([x, y]))
    x, y = x[head:], y[head:]
    tail = len(commonprefix([x[::-1], y[::-1]]))
    x, y = sorted((x[: len(x) - tail], y[: len(y) - tail]), key=len)
    signs = np.frombuffer(x.encode(), np.uint8)
    masks = {c: int.from_bytes(np.packbits(signs == ord(c), bitorder="little").tobytes(), "little") for c in set(x)}
    whole = v = (1 << len(x)) - 1
    for c in y:
        u = v & masks.get(c, 0)
        v = (v + u | v - u) & whole
    return head + tail + len(x) - v.bit_count()


def _common_short(a: list[str], b: list[str]) -> np.ndarray:
    """Pairs of at most 64 characters, a bit for each character of ``a``."""
    n = len(a)
    la, lb = (np.array([len(x) for x in s]) for s in (a, b))
    pad = lambda s: CODES[np.frombuffer("".join(x.ljust(WORD, "=") for x in s).encode(), np.uint8)].reshape(n, WORD)
    x, y = pad(a), pad(b)
    masks = np.zeros((n, 65), np.uint64)
    rows = np.arange(n)
    for i in range(int(la.max(initial=0))):
        masks[rows, x[:, i]] |= np.uint64(1) << np.uint64(i)
    masks[:, -1] = 0  # where padding went
    v = np.full(n, ~np.uint64(0))
    with np.errstate(over="ignore"):
        for i in range(int(lb.max(initial=0))):
            u = v & masks[rows, y[:, i]]
            v = (v + u) | (v - u)
    mask = np.where(la >= 64, ~np.uint64(0), (np.uint64(1) << np.minimum(la, 63).astype(np.uint64)) - np.uint64(1))
    return np.bitwise_count(~v & mask).astype(np.int64)


def _alike(a: list[str], b: list[str]) -> np.ndarray:
    total = np.array([len(x) + len(y) for x, y in zip(a, b, strict=True)])
    score = np.divide(2 * _common(a, b), total, out=np.ones(len(a)), where=total > 0)
    for i, (x, y) in enumerate(zip(a, b, strict=True)):  # chance likeness of long signatures: no four characters in a row
        if min(len(x), len(y)) >= 8 and score[i] < 0.9 and not {x[k : k + 4] for k in range(len(x) - 3)} & {y[k : k + 4] for k in range(len(y) - 3)}:
            score[i] = 0.0
    return score


def likeness(a: list[str], b: list[str]) -> np.ndarray:
    """0 to 1 for each pair of fingerprints: the better of the comparisons at a common block size, 0 without one."""
    out = np.zeros(len(a))
    for i in range(0, len(a), 4096):
        left, right = ([x.split(":") for x in s[i : i + 4096]] for s in (a, b))
        p, q = (np.array([int(x[0]) for x in s]) for s in (left, right))
        score = out[i : i + 4096]
        for fine, u, w in ((p == q, 1, 1), (p == q, 2, 2), (p == 2 * q, 1, 2), (2 * p == q, 2, 1)):
            rows = np.flatnonzero(fine)
            if len(rows):
                score[rows] = np.maximum(score[rows], _alike([left[r][u] for r in rows], [right[r][w] for r in rows]))
    return out


def fingerprint(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fingerprint) of each row; a null text is empty, equal texts have equal fingerprints."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(fingerprints(*text_bytes(batch.column(1))), pa.string())], names=["doc_id", "fingerprint"])

    return map_arrow(df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("t")), run, "doc_id long, fingerprint string")


def in_turn(df: DataFrame, parts: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(place, guest, doc_id, text) such that each row is followed, in its place, by its successor.

    The order is by descending id (null last, ties by a hash of the text); rows are dealt to places
    by ranges of ids, and the first row of the next place follows as a guest. The very first row
    follows the very last. Only cut points and one id for each place reach the driver.
    """
    spark = df.sparkSession
    rows = df.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")).withColumn("th", F.xxhash64("text"))
    cuts = sorted(set(rows.approxQuantile("doc_id", [i / parts for i in range(1, parts)], 0.001))) if parts > 1 else []

    @F.pandas_udf("long")
    def range_of(ids):
        import pandas as pd

        return pd.Series(np.where(ids.isna(), 0, np.searchsorted(np.array(cuts), ids.fillna(0).to_numpy(np.float64), side="right") + 1))

    rows = rows.withColumn("place", range_of(F.col("doc_id")))
    heads = {r["place"]: r["h"] for r in rows.groupBy("place").agg(F.max(F.struct("doc_id", "th")).alias("h")).collect()}
    used = sorted(heads)
    # the first row of a place follows the last of the next higher one; that of the highest, the last of all
    guests = [(b, heads[b]["doc_id"], heads[b]["th"], used[(i + 1) % len(used)]) for i, b in enumerate(used)]
    guests = spark.createDataFrame(guests, "hp long, hid long, hth long, target long")
    match = (F.col("place") == F.col("hp")) & F.col("doc_id").eqNullSafe(F.col("hid")) & (F.col("th") == F.col("hth"))
    rows = rows.join(F.broadcast(guests), match, "left")  # one row for each place
    to = F.array_compact(F.array(F.struct(F.col("place").alias("place"), F.lit(False).alias("guest")), F.when(F.col("target").isNotNull(), F.struct(F.col("target").alias("place"), F.lit(True).alias("guest")))))
    rows = rows.select("doc_id", "text", "th", F.explode(to).alias("x")).select("x.place", "x.guest", "doc_id", "text", "th")
    return rows.repartition(parts, "place").sortWithinPartitions("place", "guest", F.desc_nulls_last("doc_id"), F.desc("th")).drop("th")


def _edited(text: str, following: str) -> str:
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


FIELDS = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def _compared(batches):
    """Every own row with its successor; the last row of a batch waits for the next one."""
    held: tuple | None = None  # place, guest, id, text, fingerprint

    def rows():
        nonlocal held
        for batch in batches:
            place, guest, ids, texts = (batch.column(i).to_pylist() for i in range(4))
            for a, b in blocks([len(t) for t in texts], 2_000_000):
                marks = fingerprints(*text_bytes(pa.array(texts[a:b], pa.large_string())))
                part = list(zip(place[a:b], guest[a:b], ids[a:b], texts[a:b], marks, strict=True))
                yield ([held] if held else []) + part
                held = part[-1]

    for part in rows():
        pairs = [(x, y) for x, y in zip(part, part[1:], strict=False) if not x[1] and x[0] == y[0]]
        if not pairs:
            continue
        edited = [_edited(x[3], y[3]) for x, y in pairs]
        marks = fingerprints(*text_bytes(pa.array(edited, pa.large_string())))
        own, after = [x[4] for x, _ in pairs], [y[4] for _, y in pairs]
        yield pa.RecordBatch.from_arrays([
            pa.array([x[2] for x, _ in pairs], pa.int64()), pa.array([len(x[3]) for x, _ in pairs], pa.int64()),
            pa.array([hashlib.sha256(e.encode()).hexdigest() for e in edited]), pa.array(own), pa.array(marks),
            pa.array(likeness(own, marks)), pa.array(likeness(own, after)),
        ], names=[f.split()[0] for f in FIELDS.split(", ")])


def compare_edits(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of every text, of the text with its later half taken from the next document, and their likeness (FIELDS).

    Null texts are empty. Rows with equal ids follow one another by a hash of their texts; null ids
    come last. A single row follows itself; an empty table gives an empty result.
    """
    if df.isEmpty():
        return df.sparkSession.createDataFrame([], FIELDS)
    parts = max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1)
    return in_turn(df, parts, id_col, text_col).mapInArrow(_compared, FIELDS)


def op5_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compare_edits(documents(spark, sf_dir))
