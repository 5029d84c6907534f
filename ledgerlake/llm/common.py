"""Small helpers shared by the operators: scratch tables, ragged arrays, components."""

from __future__ import annotations

import ctypes
import ctypes.util
import gc
import hashlib
import uuid
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.session import shared_dir, shuffles_freed


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh folder below the shared folder of the cluster (``spark.checkpoint.dir``)."""
    return f"{shared_dir(spark)}/ledgerlake-llm/{name}-{uuid.uuid4().hex[:12]}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: later stages never replay what is above."""
    path = scratch(df.sparkSession, name)
    with shuffles_freed(df.sparkSession):
        df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


HELD: dict = {}  # what an operator keeps in a worker from one task to the next


def held(name: str, make: Callable[[], object]):
    """The worker's object of this name, made when first asked for."""
    if name not in HELD:
        HELD[name] = make()
    return HELD[name]


def hand_back(keep: str = "") -> None:
    """Drop what is held but ``keep`` and give freed memory back to the system: workers outlive the tasks they serve."""
    for name in [x for x in HELD if x != keep]:
        del HELD[name]
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(ctypes.util.find_library("c")), "malloc_trim", None)
    if trim:
        trim(0)


def trimmed(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], keep: str = ""):
    """``run`` over the batches of a partition, with no memory left over from other operators before it or from itself after it."""

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hand_back(keep)
        yield from run(batches)
        hand_back(keep)

    return whole


def map_arrow(df: DataFrame, fn: Callable[[pa.RecordBatch], pa.RecordBatch], schema: str, keep: str = "") -> DataFrame:
    """``fn`` over each Arrow batch (bounded in rows and bytes by Spark's Arrow settings); ``keep`` as in trimmed()."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield fn(batch)

    return df.mapInArrow(trimmed(run, keep), schema)


def strings(column: pa.Array) -> list[str]:
    """Python strings of an Arrow column, null as the empty text."""
    return [x or "" for x in column.to_pylist()]


def blocks(sizes: list[int], most: int) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``most`` in total size; a larger row makes a range of its own."""
    start = total = 0
    for i, n in enumerate(sizes):
        if i > start and total + n > most:
            yield start, i
            start, total = i, 0
        total += n
    if start < len(sizes):
        yield start, len(sizes)


def ragged_index(starts: np.ndarray, lens: np.ndarray) -> np.ndarray:
    """Positions of the ranges [start, start + len) one after the other."""
    ends = np.cumsum(lens)
    total = int(ends[-1]) if len(ends) else 0
    return np.repeat(starts - (ends - lens), lens) + np.arange(total)


def row_blocks(edges: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    return blocks(np.diff(edges).tolist(), most)


def offsets(lens: np.ndarray) -> np.ndarray:
    out = np.zeros(len(lens) + 1, np.int64)
    np.cumsum(lens, out=out[1:])
    return out


# --- bytes of texts, hashed in ranges --------------------------------------------------------------

SPAN = 1 << 21
_BASE = 0x9E3779B97F4A7C15
_MASK = (1 << 64) - 1


@lru_cache(maxsize=1)
def _powers() -> tuple[np.ndarray, np.ndarray]:
    with np.errstate(over="ignore"):
        up = np.cumprod(np.concatenate([[np.uint64(1)], np.full(SPAN, _BASE, np.uint64)]))
        down = np.cumprod(np.concatenate([[np.uint64(1)], np.full(SPAN, pow(_BASE, -1, 1 << 64), np.uint64)]))
    return up, down


def mixed(h: np.ndarray) -> np.ndarray:
    """Spreads 64-bit values (a bijection)."""
    with np.errstate(over="ignore"):
        h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string or binary column one after the other and where each row starts (and the last ends); null is empty."""
    column = column.cast(pa.large_binary()) if not pa.types.is_large_binary(column.type) else column
    column = column.fill_null(b"") if column.null_count else column
    edges = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    return (np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8))[edges[0] : edges[-1]], edges - edges[0]


def hash_ranges(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of the byte ranges, whose starts ascend."""
    out = np.zeros(len(starts), np.uint64)
    up, down = _powers()
    i = 0
    with np.errstate(over="ignore"):
        while i < len(starts):
            base = int(starts[i])
            k = int(np.searchsorted(starts, base + SPAN, side="left"))
            far = np.flatnonzero(ends[i:k] > base + SPAN)
            k = i + int(far[0]) if len(far) else k
            if k == i:  # a single range longer than the table of powers
                digest = hashlib.blake2b(data[base : int(ends[i])].tobytes(), digest_size=8).digest()
                out[i] = int.from_bytes(digest, "little")
                i += 1
                continue
            stop = int(ends[i:k].max())
            sums = np.zeros(stop - base + 1, np.uint64)
            np.cumsum((data[base:stop].astype(np.uint64) + np.uint64(1)) * up[: stop - base], out=sums[1:])
            first, last = starts[i:k] - base, ends[i:k] - base
            out[i:k] = (sums[last] - sums[first]) * down[first] + (last - first).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)
            i = k
    return mixed(out)


class Words:
    """Numbers the distinct byte ranges met so far and keeps what ``encode`` makes of each.

    Ranges are known by their 64-bit hash. ``encode(list of bytes)`` returns (values one after the
    other, how many each has). The table starts anew when it holds ``most`` ranges, so that its
    memory is bounded whatever the vocabulary; results do not depend on that.
    """

    def __init__(self, encode: Callable[[list[bytes]], tuple[np.ndarray, np.ndarray]], most: int = 1_000_000):
        self.encode, self.most = encode, most
        self.bits = max(10, int(most * 3).bit_length())
        self.reset()

    def reset(self) -> None:
        self.keys, self.at = np.zeros(1 << self.bits, np.uint64), np.zeros(1 << self.bits, np.int32)
        self.count, self.used, self.flat = 0, 0, None
        self.starts, self.lens = np.zeros(4096, np.int64), np.zeros(4096, np.int64)

    def _find(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each hash its slot (its own or the first free one) and whether it is there."""
        slot = (h >> np.uint64(64 - self.bits)).astype(np.int64)
        there = self.keys[slot]
        known = there == h
        walk = np.flatnonzero(~known & (there != 0))
        while len(walk):
            slot[walk] = (slot[walk] + 1) & ((1 << self.bits) - 1)
            there = self.keys[slot[walk]]
            known[walk] = there == h[walk]
            walk = walk[(there != h[walk]) & (there != 0)]
        return slot, known

    def number(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """The number of each range; ranges not known are encoded at once. Starts ascend."""
        h = hash_ranges(data, starts, ends)
        h[h == 0] = np.uint64(1)
        if self.count > self.most:
            self.reset()
        slot, known = self._find(h)
        if not known.all():
            miss = np.flatnonzero(~known)
            new, first = np.unique(h[miss], return_index=True)
            first = miss[first]
            if self.count + len(new) > 2 * self.most:  # more new ranges at once than the table is made for
                self.reset()
                if len(new) > 2 * self.most:
                    self.bits = int(len(new) * 2).bit_length()
                    self.reset()
                return self._number_anew(data, starts, ends, h)
            self._insert(new, data, starts[first], ends[first])
            slot[miss], _ = self._find(h[miss])
        return self.at[slot].astype(np.int64)

    def _number_anew(self, data, starts, ends, h):
        new, first = np.unique(h, return_index=True)
        self._insert(new, data, starts[first], ends[first])
        return self.at[self._find(h)[0]].astype(np.int64)

    def _insert(self, new: np.ndarray, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> None:
        values, lens = self.encode([data[a:b].tobytes() for a, b in zip(starts.tolist(), ends.tolist(), strict=True)])
        numbers = np.arange(self.count, self.count + len(new))
        left = np.arange(len(new))
        while len(left):
            slot, _ = self._find(new[left])
            self.keys[slot] = new[left]
            won = self.keys[slot] == new[left]
            self.at[slot[won]] = numbers[left[won]]
            left = left[~won]
        n, total = self.count + len(new), self.used + len(values)
        if n > len(self.lens):
            self.starts = np.concatenate([self.starts, np.zeros(n, np.int64)])
            self.lens = np.concatenate([self.lens, np.zeros(n, np.int64)])
        if self.flat is None:
            self.flat = np.zeros((max(4096, 2 * total), *values.shape[1:]), values.dtype)
        elif total > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros((total, *values.shape[1:]), values.dtype)])
        self.flat[self.used : total] = values
        self.lens[self.count : n] = lens
        self.starts[self.count : n] = self.used + np.cumsum(lens) - lens
        self.count, self.used = n, total

    def values(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The values of the numbered ranges one after the other, and how many each has."""
        lens = self.lens[numbers]
        if self.flat is None:
            return np.zeros(0, np.int64), lens
        return self.flat[ragged_index(self.starts[numbers], lens)], lens


NONE = np.zeros(0, np.int64)
SPACES = np.zeros(256, bool)
SPACES[[9, 10, 11, 12, 13, 32]] = True


LETTERS, SIGNS = np.zeros(256, bool), np.zeros(256, bool)
LETTERS[[*range(65, 91), *range(97, 123)]] = True
SIGNS[[c for c in range(33, 127) if not chr(c).isalnum()]] = True


def letter_sign_cuts(data: np.ndarray) -> np.ndarray:
    """Positions where an ASCII letter meets an ASCII sign, or a sign other than the apostrophe a letter.

    Split patterns that know letters, signs and contractions such as 's always cut there.
    """
    letter, sign = LETTERS[data], SIGNS[data]
    return np.flatnonzero((letter[:-1] & sign[1:]) | (sign[:-1] & letter[1:] & (data[:-1] != 39))) + 1


def merged_cuts(*cuts: np.ndarray) -> np.ndarray:
    """Ascending distinct positions."""
    out = np.sort(np.concatenate(cuts))
    return out[np.append(True, out[1:] != out[:-1])] if len(out) else out


def word_ranges(data: np.ndarray, edges: np.ndarray, space: np.ndarray = SPACES, more: np.ndarray = NONE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the runs without white space in each row, cut at ``more`` too, and how many each row has."""
    inside = np.zeros(len(data) + 2, bool)
    inside[1:-1] = ~space[data]
    starts = np.flatnonzero(inside[1:] & ~inside[:-1])
    ends = np.flatnonzero(inside[:-1] & ~inside[1:])
    cuts = edges[1:-1]  # a run that goes over the end of a row is two
    cuts = merged_cuts(cuts[(cuts > 0) & (cuts < len(data))], more)
    cuts = cuts[inside[cuts] & inside[cuts + 1]]
    if len(cuts):
        starts, ends = np.sort(np.concatenate([starts, cuts])), np.sort(np.concatenate([ends, cuts]))
    return starts, ends, np.diff(np.searchsorted(starts, edges))


def binary_column(values: np.ndarray, ends: np.ndarray) -> pa.Array:
    """A binary column of the byte ranges that ``ends`` (with a leading 0, in items) cuts out of ``values``."""
    data = np.ascontiguousarray(values)
    edges = (np.asarray(ends, np.int64) * data.itemsize).astype(np.int64)
    return pa.Array.from_buffers(pa.large_binary(), len(edges) - 1, [None, pa.py_buffer(edges.tobytes()), pa.py_buffer(data.tobytes())]).cast(pa.binary())


# --- rolling sums of counted groups ---------------------------------------------------------------


def running_start(df: DataFrame, order: str, value: str, out: str, block: int = 4096) -> DataFrame:
    """Adds the sum of ``value`` over all smaller ``order`` (a dense integer): sums by block, then inside blocks."""
    from pyspark.sql import Window as W

    b = F.floor(F.col(order) / block)
    tops = df.groupBy(b.alias("__b")).agg(F.sum(value).alias("__s"))
    tops = tops.select("__b", (F.sum("__s").over(W.orderBy("__b")) - F.col("__s")).alias("__before"))
    inner = W.partitionBy("__b").orderBy(order)
    return (
        df.withColumn("__b", b).withColumn("__in", F.sum(value).over(inner) - F.col(value))
        .join(tops, "__b").withColumn(out, F.col("__in") + F.col("__before")).drop("__b", "__in", "__before")
    )


# --- connected components -------------------------------------------------------------------------


def local_forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each batch of edges (a, b) keep a spanning forest, every member linked to its smallest."""
    for batch in batches:
        a, b = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
        ids, flat = np.unique(np.concatenate([a, b]), return_inverse=True)
        x, y = flat[: len(a)], flat[len(a) :]
        root = np.arange(len(ids))
        while True:  # hooking by minimum and pointer jumping on the dense ids
            low = root.copy()
            np.minimum.at(low, root[x], root[y])
            np.minimum.at(low, root[y], root[x])
            while not np.array_equal(low, low[low]):
                low = low[low]
            new = low[root]
            if np.array_equal(new, root):
                break
            root = new
        keep = root != np.arange(len(ids))
        yield pa.RecordBatch.from_arrays([pa.array(ids[keep]), pa.array(ids[root[keep]])], names=["a", "b"])


def components(edges: DataFrame, name: str, most_rounds: int = 60) -> DataFrame:
    """(node, root): the smallest node reachable from every node that has an edge (columns a, b; long).

    Every round hooks each node to its smallest neighbour and contracts the rest: stars shrink to
    one edge by a map-side minimum, so a hub with a third of all nodes is no hot group. Tables of
    each round are written to the shared folder; only one count reaches the driver.
    """
    spark = edges.sparkSession
    live = edges.filter("a <> b").select(F.col("a").cast("long"), F.col("b").cast("long")).mapInArrow(trimmed(local_forest), "a long, b long")
    live = stored(live.distinct(), f"{name}-edges")
    parent: DataFrame | None = None
    for k in range(most_rounds):
        if live.isEmpty():
            break
        both = live.select("a", "b").union(live.select(F.col("b"), F.col("a")))
        hook = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("node"), F.least("a", "m").alias("up"))
        hook = stored(hook, f"{name}-hook{k}")
        # one jump: the parent of the parent, where it has one
        far = hook.select(F.col("node").alias("up"), F.col("up").alias("far"))
        hook = hook.join(far, "up", "left").select("node", F.coalesce("far", "up").alias("up"))
        hook = stored(hook, f"{name}-up{k}")
        if parent is None:
            parent = hook
        else:
            step = hook.select(F.col("node").alias("up"), F.col("up").alias("nup"))
            parent = parent.join(step, "up", "left").select("node", F.coalesce("nup", "up").alias("up"))
            parent = stored(parent, f"{name}-parent{k}")
        to = lambda c: hook.select(F.col("node").alias(c), F.col("up").alias(f"{c}2"))
        live = live.join(to("a"), "a").join(to("b"), "b").filter("a2 <> b2").select(F.col("a2").alias("a"), F.col("b2").alias("b"))
        live = stored(live.mapInArrow(trimmed(local_forest), "a long, b long").distinct(), f"{name}-live{k}")
    else:
        raise RuntimeError("components did not settle")
    if parent is None:
        return spark.createDataFrame([], "node long, root long")
    return parent.select("node", F.col("up").alias("root"))


def spread(column: Column | str, n: int) -> Column:
    """A bucket 0..n-1 by hash."""
    return F.pmod(F.xxhash64(column), F.lit(n))


KEY = "ledger_key__"


def keyed_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, bool]:
    """The rows with a column KEY, a distinct long for each distinct (id, text) in the order of the ids, and whether it is the id.

    It is the id itself where ids are distinct and not null. Otherwise the distinct (id, hash of the
    text) are numbered in order, null first, so that rows with one id and different texts are
    different documents and rows that repeat both are the same one.
    """
    own = F.col(id_col).cast("long")
    if docs.groupBy(own.alias("i")).count().filter("i is null or count > 1").isEmpty():
        return docs.withColumn(KEY, own), True
    rows = docs.withColumn("ledger_id__", own).withColumn("ledger_hash__", F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))))
    order = rows.select("ledger_id__", "ledger_hash__").distinct().sort("ledger_id__", "ledger_hash__")
    numbered = order.rdd.zipWithIndex().map(lambda x: (x[1], x[0][0], x[0][1])).toDF(f"{KEY} long, id2 long, th2 long")
    numbered = stored(numbered, "keys")
    same = rows["ledger_id__"].eqNullSafe(numbered["id2"]) & (rows["ledger_hash__"] == numbered["th2"])
    return rows.join(numbered, same).drop("ledger_id__", "ledger_hash__", "id2", "th2"), False


def with_key(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(key, doc_id, text) of keyed_rows()."""
    rows, _ = keyed_rows(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")))
    return rows.select(F.col(KEY).alias("key"), "doc_id", "text")


def whole_groups(batches: Iterator[pa.RecordBatch], keys: list[str], most: int = 20_000) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Tables of whole groups from batches sorted by the key columns, and where each group starts (and the last ends).

    A group must be bounded; about ``most`` rows come at a time.
    """
    held: list[pa.RecordBatch] = []
    rows = 0

    def starts(table: pa.Table) -> np.ndarray:
        cols = [table.column(k).to_numpy() for k in keys]
        new = np.zeros(max(0, len(table) - 1), bool)
        for c in cols:
            new |= c[1:] != c[:-1]
        return np.concatenate([[0], np.flatnonzero(new) + 1, [len(table)]])

    for batch in batches:
        held.append(batch)
        rows += batch.num_rows
        if rows < most:
            continue
        table = pa.Table.from_batches(held)
        at = starts(table)
        if len(at) > 2:
            yield table.slice(0, at[-2]), at[:-1]
            table = table.slice(at[-2])
        held, rows = table.combine_chunks().to_batches(), len(table)
        rows = 0 if len(at) == 2 else rows
    if held and sum(b.num_rows for b in held):
        table = pa.Table.from_batches(held)
        yield table, starts(table)
