"""Repeated passages by a depth-limited radix sort of suffixes.

Suffixes need to be ordered only through the first ``window`` bytes: suffixes equal that far are
exactly the repeated windows. The passes take the most significant digits first and hand on only
suffixes that still have company:

1. Digit one is the window's synchronising string: of all its ``grain``-byte strings the one whose
   hash is least. Equal windows have it at the same offset, so windows that follow one another share
   one row per string instead of having one row each. Strings that occur once end here.
2. Digit two is the whole stretch of bytes that the windows of such a row cover. Rows equal in both
   digits repeat each other throughout: all but the earliest are settled.
3. What is left (rows whose string has different stretches around it) is taken apart into its
   windows, and digit three is the window itself.

Digits are compared by hashes, two of them for any pair called equal: digits one and two, 64 bits
each, and for digit three 64 bits and, by another polynomial, 32 more. Passes are shuffles by
digit; each task first settles repeats within its own batch, which leaves one row per batch of any
digit however hot, and strings with many stretches in a batch are spread over the tasks.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ledgerlake.llm.common import SPAN, _powers, documents, mixed, ragged_index, row_blocks, stored, text_bytes, trimmed, with_key

WINDOW, GRAIN = 100, 48
HOT = 64  # stretches of one string in one batch, from which the string is spread over tasks
MANY = np.int64(-(1 << 62))  # stands for the stretches of a spread string at its home


def _rows_of(data: np.ndarray, edges: np.ndarray, window: int, grain: int):
    """(row in the block, first start, starts, digit one, digit two) of all windows of a block of at most SPAN bytes."""
    n, wide = len(data), window - grain + 1
    none = [np.zeros(0, np.int64)] * 3 + [np.zeros(0, np.uint64)] * 2
    doc = np.repeat(np.arange(len(edges) - 1), np.diff(edges))
    valid = np.flatnonzero(np.arange(n) + window <= edges[1:][doc]) if n >= window else np.zeros(0, np.int64)
    if not len(valid):
        return none
    up, down = _powers()
    with np.errstate(over="ignore"):
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[:n], out=sums[1:])
        grams = mixed((sums[grain:] - sums[:-grain]) * down[: n + 1 - grain])
    low = np.uint64(SPAN * 2 - 1)
    order = (grams & ~low) | np.arange(len(grams), dtype=np.uint64)
    pad = -len(order) % wide
    table = np.concatenate([order, np.full(pad, ~np.uint64(0))]).reshape(-1, wide)
    ahead = np.minimum.accumulate(table, axis=1).ravel()
    back = np.minimum.accumulate(table[:, ::-1], axis=1)[:, ::-1].ravel()
    at = (np.minimum(back[valid], ahead[valid + wide - 1]) & low).astype(np.int64)
    new = np.flatnonzero(np.concatenate([[True], (at[1:] != at[:-1]) | (valid[1:] != valid[:-1] + 1)]))
    first, last = valid[new], valid[np.append(new[1:] - 1, len(valid) - 1)]
    at = at[new]
    with np.errstate(over="ignore"):
        stretch = mixed((sums[last + window] - sums[first]) * down[first] + mixed((at - first).astype(np.uint64) * np.uint64(1 << 20) + (last - first).astype(np.uint64)))
    return doc[first], first - edges[:-1][doc[first]], last - first + 1, grams[at], stretch


PIECE = SPAN // 4  # bytes whose windows are held at once


def _slices(data: np.ndarray, edges: np.ndarray, window: int):
    """(row, offset in the row, bytes, edges) in pieces of at most PIECE bytes; longer rows overlap by window - 1."""
    for a, b in row_blocks(edges, PIECE):
        size = int(edges[b] - edges[a])
        if size <= PIECE:
            yield a, 0, data[edges[a] : edges[b]], edges[a : b + 1] - edges[a]
            continue
        for x in range(0, max(1, size - window + 1), PIECE - window + 1):
            part = data[edges[a] + x : min(edges[b], edges[a] + x + PIECE)]
            yield a, x, part, np.array([0, len(part)])


def _union(starts: np.ndarray, lens: np.ndarray, group: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Maximal runs (group, start, length) of byte ranges, by group."""
    if not len(starts):
        return group, starts, lens
    order = np.lexsort((starts, group))
    group, starts, ends = group[order], starts[order], (starts + lens)[order]
    new_group = np.concatenate([[True], group[1:] != group[:-1]])
    # the furthest end so far within the group: groups are lifted apart, then a running maximum
    lift = np.cumsum(new_group) * (int(ends.max()) + 1)
    far = np.maximum.accumulate(ends + lift) - lift
    new = np.concatenate([[True], new_group[1:] | (starts[1:] > far[:-1])])
    head = np.flatnonzero(new)
    last = np.append(head[1:] - 1, len(starts) - 1)
    return group[head], starts[head], far[last] - starts[head]


def _settled(keys: np.ndarray, starts: np.ndarray, lens: np.ndarray):
    """Byte ranges of known repeats, united where they touch."""
    ids, group = np.unique(keys, return_inverse=True)
    group, starts, lens = _union(starts, lens, group)
    return ids[group], starts, lens


@lru_cache(maxsize=1)
def _second() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Values of the bytes, powers and inverse powers of the second hash of a window, modulo 2**32."""
    base = 0x85EBCA6B
    with np.errstate(over="ignore"):
        up, down = (np.cumprod(np.concatenate([[1], np.full(SPAN, b)]).astype(np.uint32), dtype=np.uint32) for b in (base, pow(base, -1, 1 << 32)))
    return mixed(np.arange(1, 257, dtype=np.uint64)).astype(np.uint32), up, down


ROWS = "p long, k long, c long, key long, a long, n int, sure boolean"


def _first_digits(window: int, grain: int, most: int):
    """Rows of digits one and two; repeats within the batch are settled (sure: [a, a + n) is repeated)."""

    def run(batches):
        for batch in batches:
            data, edges = text_bytes(batch.column(1))
            keys = batch.column(0).to_numpy(zero_copy_only=False)
            parts = []
            for row, at, piece, cut in _slices(data, edges, window):
                doc, a, n, k, c = _rows_of(piece, cut, window, grain)
                parts.append((keys[row + doc], a + at, n, k.view(np.int64), c.view(np.int64)))
            key, a, n, k, c = (np.concatenate(x) for x in zip(*parts, strict=True)) if parts else [np.zeros(0, np.int64)] * 5
            order = np.lexsort((a, key, c, k))
            key, a, n, k, c = (x[order] for x in (key, a, n, k, c))
            again = np.concatenate([[False], (k[1:] == k[:-1]) & (c[1:] == c[:-1])]) if len(k) else np.zeros(0, bool)
            sk, sa, sn = _settled(key[again], a[again], n[again] + window - 1)
            key, a, n, k, c = (x[~again] for x in (key, a, n, k, c))
            heads = np.flatnonzero(np.concatenate([[True], k[1:] != k[:-1]])) if len(k) else np.zeros(0, np.int64)
            count = np.diff(np.append(heads, len(k)))
            hot = np.repeat(count >= most, count)
            p = np.where(hot, c ^ k, k)
            mark = k[heads[count >= most]]  # tells the string's home that there are more
            m, s = len(mark), len(sk)
            zero = np.zeros(m, np.int64)
            for x in range(0, len(k) + m + s, 200_000):
                cols = [
                    np.concatenate([p, mark, sk]), np.concatenate([k, mark, sk]), np.concatenate([np.where(hot, c | 1, c & ~1) if len(c) else c, zero + MANY, sk]),
                    np.concatenate([key, zero - 1, sk]), np.concatenate([a, zero, sa]), np.concatenate([n, zero, sn]).astype(np.int32), np.concatenate([np.zeros(len(k) + m, bool), np.ones(s, bool)]),
                ] if x == 0 else cols
                yield pa.RecordBatch.from_arrays([pa.array(v[x : x + 200_000]) for v in cols], names=["p", "k", "c", "key", "a", "n", "sure"])

    return run


def _windows(window: int):
    """Digit three: (w, x, key, s) of every window of the rows in question, w and x its hashes; repeats within the batch are settled (w null)."""

    def run(batches):
        for batch in batches:
            data, edges = text_bytes(batch.column(2))
            keys = batch.column(0).to_numpy(zero_copy_only=False)
            lists = batch.column(3)
            lo = np.asarray(lists.offsets)
            rows = lists.values
            a = rows.field("a").to_numpy(zero_copy_only=False)
            n = rows.field("n").to_numpy(zero_copy_only=False).astype(np.int64)
            up, down = _powers()
            values, up2, down2 = _second()
            ws, xs, ks, ss = [], [], [], []
            for i in range(batch.num_rows):
                starts = np.unique(ragged_index(a[lo[i] : lo[i + 1]], n[lo[i] : lo[i + 1]]))
                text = data[edges[i] : edges[i + 1]]
                for x in range(0, len(starts), 1 << 16):
                    part = starts[x : x + (1 << 16)]
                    while len(part):
                        base = int(part[0])
                        here = part[part < base + SPAN - window]
                        part = part[len(here) :]
                        stop = int(here[-1]) + window
                        with np.errstate(over="ignore"):
                            sums = np.zeros(stop - base + 1, np.uint64)
                            np.cumsum((text[base:stop].astype(np.uint64) + np.uint64(1)) * up[: stop - base], out=sums[1:])
                            ws.append(mixed((sums[here - base + window] - sums[here - base]) * down[here - base]).view(np.int64))
                            sums = np.zeros(stop - base + 1, np.uint32)
                            np.cumsum(values[text[base:stop]] * up2[: stop - base], out=sums[1:])
                            xs.append(((sums[here - base + window] - sums[here - base]) * down2[here - base]).view(np.int32))
                        ss.append(here)
                        ks.append(np.full(len(here), keys[i]))
            if not ws:
                continue
            w, x, k, s = (np.concatenate(v) for v in (ws, xs, ks, ss))
            order = np.lexsort((s, k, x, w))
            w, x, k, s = (v[order] for v in (w, x, k, s))
            again = np.concatenate([[False], (w[1:] == w[:-1]) & (x[1:] == x[:-1])])
            dk, ds, dn = _settled(k[again], s[again], np.full(int(again.sum()), window))
            w, x, k, s = (v[~again] for v in (w, x, k, s))
            for i in range(0, len(w), 200_000):
                cols = [v[i : i + 200_000] for v in (w, x, k, s)]
                yield pa.RecordBatch.from_arrays([pa.array(v) for v in [*cols, np.full(len(cols[0]), window, np.int64)]], names=["w", "x", "key", "s", "m"])
            if len(dk):
                yield pa.RecordBatch.from_arrays([pa.nulls(len(dk), pa.int64()), pa.nulls(len(dk), pa.int32()), pa.array(dk), pa.array(ds), pa.array(dn)], names=["w", "x", "key", "s", "m"])

    return run


def _cut(batches):
    """Unite the ranges of each row and take them out."""
    for batch in batches:
        data, edges = text_bytes(batch.column(2))
        lists = batch.column(3)
        lo = np.asarray(lists.offsets)
        valid = np.asarray(lists.is_valid())
        rows = lists.values
        a, n = (rows.field(f).to_numpy(zero_copy_only=False).astype(np.int64) for f in ("a", "n"))
        kept, spans, removed = [], [], []
        for i in range(batch.num_rows):
            text = data[edges[i] : edges[i + 1]]
            if not valid[i] or lo[i] == lo[i + 1]:
                kept.append(text.tobytes())
                spans.append([])
                removed.append(0)
                continue
            x, y = a[lo[i] : lo[i + 1]], n[lo[i] : lo[i + 1]]
            _, x, y = _union(x, y, np.zeros(len(x), np.int64))
            mask = np.ones(len(text), bool)
            mask[ragged_index(x, y)] = False
            kept.append(text[mask].tobytes())
            spans.append([{"a": int(p), "n": int(q)} for p, q in zip(x, y, strict=True)])
            removed.append(int(y.sum()))
        kind = pa.list_(pa.struct([("a", pa.int64()), ("n", pa.int64())]))
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(np.diff(edges)), pa.array(removed, pa.int64()), pa.array(spans, kind), pa.array(kept, pa.binary())], names=["key", "doc_id", "n_bytes", "n_removed", "spans", "kept"])


def remove_repeats(docs: DataFrame, window: int = WINDOW, grain: int = GRAIN, hot: int = HOT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(key, doc_id, n_bytes, n_removed, spans, kept): every text less the bytes in windows that also start earlier.

    Earlier means in a document with a smaller id or further left in the same one; see with_key()
    for null and repeated ids (rows that repeat id and text are one document and share its result;
    of rows with one id and different texts the hash of the text decides). Texts are judged as
    given, not as cut. Null texts are empty; texts shorter than the window stay whole; an empty
    table gives an empty result; other columns are ignored.
    """
    texts = with_key(docs, id_col, text_col).filter("key is not null").select("key", "doc_id", F.col("text").cast("binary").alias("text"))
    n = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1)
    rows = texts.filter(F.octet_length("text") >= window).select("key", "text").mapInArrow(trimmed(_first_digits(window, grain, hot)), ROWS)
    whole = W.partitionBy("p", "k", "sure")
    by_stretch = whole.orderBy("c", "key", "a")
    # rows of a spread string sit at p = c ^ k and are known (an odd c) to have company
    judged = (
        rows.repartition(n, "p", "k", "sure")
        .withColumn("again", F.coalesce(F.lag("c").over(by_stretch) == F.col("c"), F.lit(False)) & ~F.col("sure"))
        .withColumn("company", (F.col("c") % 2 != 0) | (F.min("c").over(whole) != F.max("c").over(whole)))
        .filter(F.col("sure") | (F.col("c") != int(MANY)) & (F.col("again") | F.col("company")))
        .select("key", "a", F.when(F.col("again"), F.col("n") + (window - 1)).otherwise(F.col("n")).cast("long").alias("n"), (F.col("sure") | F.col("again")).alias("sure"))
    )
    judged = stored(judged, "repeat-rows")
    listed = lambda df: df.groupBy("key").agg(F.collect_list(F.struct("a", "n")).alias("rows"))
    # both joins with the texts read one shuffle of them
    asked = texts.join(listed(judged.filter("not sure")), "key")
    windows = asked.select("key", "doc_id", "text", "rows").mapInArrow(trimmed(_windows(window)), "w long, x int, key long, s long, m long")
    own = F.col("w").isNull()
    nth = F.row_number().over(W.partitionBy(F.coalesce("w", "key"), "x", own).orderBy("key", "s"))
    later = windows.withColumn("nth", nth).filter(own | (F.col("nth") > 1))
    repeats = judged.filter("sure").select("key", "a", "n").union(later.select("key", "s", "m"))
    out = texts.join(listed(repeats), "key", "left")
    return out.select("key", "doc_id", "text", "rows").mapInArrow(trimmed(_cut), "key long, doc_id long, n_bytes long, n_removed long, spans array<struct<a:long,n:long>>, kept binary")


def op7_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = remove_repeats(documents(spark, sf_dir))
    return out.select("doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))
