"""Text quality by a byte-level convolutional network in numpy.

Bytes become short learned vectors; learned filters slide over windows of bytes; their responses are
max-pooled within overlapping chunks, which together cover the whole text. The chunks' features
are combined as their maximum and their mean, and a logistic layer makes one probability of them.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.llm.common import documents, map_arrow, row_blocks, text_bytes

EMBED, WIDTH, STRIDE, FILTERS = 8, 12, 4, 24
CELL = 128  # bytes; a chunk is two neighbouring cells, so chunks overlap by half
STRETCHES = 16  # of a long sampled text
SAMPLE, SAMPLE_BYTES, ROUNDS, STEPS, RATE, SEED = 4000, 2048, 12, 900, 0.01, 11
MOST = 1 << 18  # bytes whose responses are held at once


class Network:
    def __init__(self, seed: int = SEED):
        r = np.random.default_rng(seed)
        self.embed = (r.standard_normal((256, EMBED)) * 0.5).astype(np.float32)
        self.filters = (r.standard_normal((WIDTH * EMBED, FILTERS)) / np.sqrt(WIDTH * EMBED)).astype(np.float32)
        self.bias = np.zeros(FILTERS, np.float32)
        self.top = (r.standard_normal(2 * FILTERS) * 0.1).astype(np.float32)
        self.base = np.zeros(1, np.float32)

    def params(self) -> list[np.ndarray]:
        return [self.embed, self.filters, self.bias, self.top, self.base]

    def windows(self, padded: np.ndarray) -> np.ndarray:
        """The embedded windows, one for each STRIDE bytes; ``padded`` is a multiple of CELL plus WIDTH - STRIDE bytes."""
        x = self.embed[padded].ravel()
        n = (len(padded) - WIDTH + STRIDE) // STRIDE
        return np.lib.stride_tricks.as_strided(x, (n, WIDTH * EMBED), (x.strides[0] * STRIDE * EMBED, x.strides[0]))

    def cells(self, data: np.ndarray) -> np.ndarray:
        """The filters' maxima within each cell of a text, piece by piece; windows reach over the cells' ends."""
        out = []
        for a in range(0, max(1, len(data)), MOST):
            n = min(len(data) - a, MOST)
            size = max(1, -(-n // CELL)) * CELL + WIDTH - STRIDE
            piece = np.zeros(size, np.uint8)
            here = data[a : a + size]
            piece[: len(here)] = here
            y = self.windows(piece) @ self.filters
            out.append(np.maximum(y.reshape(-1, CELL // STRIDE, FILTERS).max(axis=1) + self.bias, 0))
        return np.concatenate(out)

    def scores(self, data: np.ndarray, edges: np.ndarray) -> np.ndarray:
        """The probability of each text between the edges."""
        out = np.zeros(len(edges) - 1)
        for a, b in row_blocks(edges, MOST):
            sizes = np.diff(edges[a : b + 1])
            if b - a == 1:
                cells, counts = self.cells(data[edges[a] : edges[b]]), None
                counts = np.array([len(cells)])
            else:  # texts side by side, each filled up to whole cells
                counts = np.maximum(1, -(-sizes // CELL))
                padded = np.zeros(int(counts.sum()) * CELL + WIDTH - STRIDE, np.uint8)
                start = (np.cumsum(counts) - counts) * CELL
                at = np.repeat(start - (edges[a:b] - edges[a]), sizes) + np.arange(int(sizes.sum()))
                padded[at] = data[edges[a] : edges[b]]
                y = self.windows(padded) @ self.filters
                if len(sizes) > 1:  # windows that reach into the next text see zeros there instead
                    y = self._mend(y, padded, start, counts)
                cells = np.maximum(y.reshape(-1, CELL // STRIDE, FILTERS).max(axis=1) + self.bias, 0)
            out[a:b] = self._combine(cells, counts)[0]
        return out

    def _mend(self, y, padded, start, counts):
        ends = start + counts * CELL
        for back in range(1, (WIDTH - 1) // STRIDE + 1):
            first = ends[:-1] - back * STRIDE
            rows = padded[first[:, None] + np.arange(WIDTH)]
            rows = np.where(np.arange(WIDTH) < back * STRIDE, rows, 0).astype(np.uint8)
            y[first // STRIDE] = self.embed[rows].reshape(len(first), -1) @ self.filters
        return y

    def _combine(self, cells: np.ndarray, counts: np.ndarray):
        """(probabilities, and what training needs) of texts of so many cells each."""
        at = np.cumsum(counts) - counts
        # chunk i: cells i and i + 1 of a text; the last cell of a text makes one with itself
        after = np.arange(len(cells)) + 1
        after[at + counts - 1] -= 1
        second = cells[after] > cells
        chunks = np.maximum(cells, cells[after])
        high = np.maximum.reduceat(chunks, at, axis=0)
        mean = np.add.reduceat(chunks, at, axis=0) / counts[:, None]
        z = np.concatenate([high, mean], axis=1) @ self.top + self.base[0]
        return 1 / (1 + np.exp(-np.clip(z, -30, 30))), (at, after, second, chunks, high, mean)

    def fit(self, texts: list[bytes], labels: np.ndarray, rounds: int = ROUNDS, rate: float = RATE, seed: int = SEED) -> Network:
        """Logistic loss by Adam in small batches, STEPS of them at least; a round sees a stretch of at most SAMPLE_BYTES of each sampled text."""
        r = np.random.default_rng(seed)
        params = self.params()
        m, v = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
        step = 0
        rounds = max(rounds, -(-STEPS * 32 // max(1, len(texts))))
        for epoch in range(rounds):
            order = r.permutation(len(texts))
            pace = rate * 0.5 * (1 + np.cos(np.pi * epoch / rounds))
            for x in range(0, len(order), 32):
                pick = order[x : x + 32]
                grads = self._gradients([texts[i] for i in pick], labels[pick], r)
                step += 1
                for p, g, a, b in zip(params, grads, m, v, strict=True):
                    g = g + 1e-4 * p
                    a += 0.1 * (g - a)
                    b += 0.001 * (g * g - b)
                    p -= (pace * (a / (1 - 0.9**step)) / (np.sqrt(b / (1 - 0.999**step)) + 1e-8)).astype(p.dtype)
        return self

    def _gradients(self, texts: list[bytes], labels: np.ndarray, r) -> list[np.ndarray]:
        rows, counts = [], []
        for t in texts:
            if len(t) > SAMPLE_BYTES:
                at = int(r.integers(0, len(t) - SAMPLE_BYTES + 1))
                t = t[at : at + SAMPLE_BYTES]
            n = max(1, -(-len(t) // CELL))
            rows.append(t.ljust(n * CELL, b"\0"))
            counts.append(n)
        counts = np.array(counts)
        data = np.frombuffer(b"".join(rows) + b"\0" * (WIDTH - STRIDE), np.uint8)
        x = self.windows(data)
        y = (x @ self.filters).reshape(-1, CELL // STRIDE, FILTERS)
        where = y.argmax(axis=1)
        raw = np.take_along_axis(y, where[:, None], axis=1)[:, 0] + self.bias
        cells = np.maximum(raw, 0)
        prob, (at, after, second, chunks, high, mean) = self._combine(cells, counts)
        d = ((prob - labels) / len(texts)).astype(np.float32)
        g_top = np.concatenate([high, mean], axis=1).T @ d
        g_chunk = np.repeat(d[:, None] * self.top[FILTERS:] / counts[:, None], counts, axis=0).astype(np.float32)
        doc = np.repeat(np.arange(len(counts)), counts)
        is_high = chunks >= high[doc]
        share = np.add.reduceat(is_high, at, axis=0)[doc]
        g_chunk += is_high / share * (d[:, None] * self.top[:FILTERS])[doc]
        g_cell = np.where(second, 0, g_chunk)
        np.add.at(g_cell, after, np.where(second, g_chunk, 0))
        g_raw = np.where(raw > 0, g_cell, 0).astype(np.float32)
        cell = np.arange(len(cells))[:, None] * (CELL // STRIDE)
        g_filters, g_embed = np.zeros_like(self.filters), np.zeros_like(self.embed)
        for f in range(FILTERS):
            use = np.flatnonzero(g_raw[:, f])
            if not len(use):
                continue
            win = (cell[use, 0] + where[use, f])
            g_filters[:, f] = x[win].T @ g_raw[use, f]
            spots = data[(win * STRIDE)[:, None] + np.arange(WIDTH)]
            g_x = g_raw[use, f][:, None, None] * self.filters[:, f].reshape(1, WIDTH, EMBED)
            flat = spots.ravel()
            for e in range(EMBED):
                g_embed[:, e] += np.bincount(flat, weights=g_x[:, :, e].ravel(), minlength=256)
        return [g_embed, g_filters, g_raw.sum(axis=0), g_top, np.array([d.sum()], np.float32)]


def stretches(text: Column, key: Column) -> Column:
    """The whole text, in bytes, or of a long one STRETCHES stretches of SAMPLE_BYTES, one from anywhere in each part of it."""
    size = F.octet_length(text)
    step = (size - SAMPLE_BYTES) / STRETCHES
    at = [F.floor((i + F.pmod(F.xxhash64(key, F.lit(i)), F.lit(1 << 20)) / (1 << 20)) * step) for i in range(STRETCHES)]
    return F.when(size <= STRETCHES * SAMPLE_BYTES, text).otherwise(F.concat(*[F.substring(text, (a + 1).cast("int"), SAMPLE_BYTES) for a in at]))


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", **options) -> Network:
    """A network fitted on at most ``sample`` labelled documents, chosen by a hash of their ids.

    Documents without a text count as empty, labels that are null are left out; without any labelled
    document the network stays as it starts. Of a long text the driver gets stretches() from all over it.
    """
    marked = labels.filter(F.col(label_col).isNotNull() & F.col(id_col).isNotNull()).groupBy(id_col).agg(F.max(label_col).alias("y"))
    marked = marked.orderBy(F.xxhash64(id_col, F.lit(SEED)), id_col).limit(sample)
    rows = docs.select(F.col(id_col), F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("t")).join(F.broadcast(marked), id_col)
    rows = rows.select(id_col, stretches(F.col("t"), F.col(id_col)).alias("t"), "y").toPandas()
    net = Network()
    if len(rows):
        rows = rows.sort_values([id_col, "y"], kind="stable")
        net.fit([bytes(t) for t in rows.t], rows.y.to_numpy(np.float32), **options)
    return net


def score(docs: DataFrame, net: Network, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, score) of every whole text; null is empty. Other columns are ignored."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(net.scores(*text_bytes(batch.column(1))))], names=["doc_id", "score"])

    return map_arrow(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("t")), run, "doc_id long, score double")


def remainder(n: int) -> Column:
    return F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(n))


def fitted(spark: SparkSession, docs: DataFrame, sf_dir: str) -> Network:
    """The network of the labels table, its rows with remainder 0 held out."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return train(docs, labels.filter(remainder(5) != 0))


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    out = score(docs, fitted(spark, docs, sf_dir))
    return out.select("doc_id", F.coalesce(remainder(5) == 0, F.lit(False)).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))
