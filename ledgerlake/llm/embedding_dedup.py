"""Near-duplicate vectors by Euclidean p-stable hashing.

Normalised vectors are projected on random Gaussian directions and the projections are cut into
steps of ``width``; ``k`` steps make a bucket of a table. Near vectors share a bucket in some of the
tables with the wanted recall at the threshold itself (more above it), others seldom. Whoever
shares a bucket is compared by its exact cosine in double precision; a pair counts in the first
table that brings it together. Large buckets are compared in blocks, and of a bucket only link
counts and a spanning forest leave the task, never all pairs. Equal vectors are one, with its count.
"""

from __future__ import annotations

import math
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.llm.common import components, local_forest, mixed, stored, whole_groups

SHARE, WIDTH, RECALL, SEED = 0.9, 2.5, 0.98, 17
BLOCK = 512


def same_step(distance: float, width: float) -> float:
    """The chance that two points at this distance fall in one step of a random projection."""
    x = width / distance
    return math.erf(x / math.sqrt(2)) - 2 / (math.sqrt(2 * math.pi) * x) * (1 - math.exp(-x * x / 2))


def plan(n: int, share: float, width: float, recall: float) -> tuple[int, int]:
    """(steps of a bucket, tables): a quarter of an unrelated vector in each bucket, and the recall at the threshold."""
    near, far = same_step(math.sqrt(2 - 2 * share), width), same_step(math.sqrt(2), width)
    k = max(1, math.ceil(math.log(4 * max(n, 2)) / -math.log(far)))
    return k, max(1, math.ceil(math.log(1 - recall) / math.log(1 - near**k)))


@lru_cache(maxsize=4)
def _directions(dim: int, k: int, tables: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    r = np.random.default_rng([seed, dim])
    return r.standard_normal((dim, k * tables)), r.random(k * tables)


def buckets(x: np.ndarray, k: int, tables: int, width: float, seed: int) -> np.ndarray:
    """The bucket (a 64-bit hash) of each unit vector in each table."""
    a, b = _directions(x.shape[1], k, tables, seed)
    steps = np.floor(x @ a / width + b).astype(np.int64).astype(np.uint64).reshape(len(x), tables, k)
    h = np.tile(np.arange(1, tables + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15), (len(x), 1)) + np.uint64(x.shape[1])
    with np.errstate(over="ignore"):
        for j in range(k):
            h = mixed(h ^ (steps[:, :, j] * np.uint64(0xD6E8FEB86659FD93) + np.uint64(j)))
    return h


def _by_size(column: pa.Array):
    """(rows, matrix) for each length among the lists of doubles."""
    edges = np.asarray(column.offsets)
    flat = column.values.to_numpy(zero_copy_only=False)
    size = np.diff(edges)
    for d in np.unique(size):
        rows = np.flatnonzero(size == d)
        yield rows, flat[(edges[rows][:, None] + np.arange(d)).ravel()].reshape(len(rows), d)


def unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _deal(k: int, tables: int, width: float, seed: int):
    def run(batches):
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            for rows, x in _by_size(batch.column(1)):
                for a in range(0, len(rows), 1000):
                    h = buckets(unit(x[a : a + 1000]), k, tables, width, seed)
                    n = len(h)
                    yield pa.RecordBatch.from_arrays([pa.array(h.T.ravel().view(np.int64)), pa.array(np.repeat(np.arange(tables, dtype=np.int32), n)), pa.array(np.tile(ids[rows[a : a + 1000]], tables))], names=["bucket", "tab", "id"])

    return run


def _shared(batches):
    """Rows of buckets with more than one vector, with its size."""
    held = [b for b in batches if b.num_rows]
    if not held:
        return
    table = pa.Table.from_batches(held)
    bucket = table.column("bucket").to_numpy()
    order = np.argsort(bucket, kind="stable")
    heads = np.flatnonzero(np.concatenate([[True], bucket[order][1:] != bucket[order][:-1]]))
    count = np.diff(np.append(heads, len(order)))
    size = np.repeat(count, count)
    keep = order[size > 1]
    out = table.take(pa.array(keep)).append_column("k", pa.array(size[size > 1]))
    yield from out.to_batches(max_chunksize=100_000)


def _compare(share: float, k: int, tables: int, width: float, seed: int):
    """Link counts and forest edges of each block pair."""

    def run(batches):
        for table, at in whole_groups(batches, ["bucket", "lo", "hi"]):
            ids, times, side, tab, other = (table.column(c).to_numpy() for c in ("id", "times", "side", "tab", "other"))
            vec = table.column("v").combine_chunks()
            edges, flat = np.asarray(vec.offsets), vec.values.to_numpy(zero_copy_only=False)
            pairs_a, pairs_b = [], []
            for s, e in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
                d = int(edges[s + 1] - edges[s])
                x = unit(flat[edges[s] : edges[e]].reshape(e - s, d))
                first = np.flatnonzero(side[s:e] == 0)
                far = np.flatnonzero(side[s:e] == 1) if other[s] else first
                i, j = np.nonzero(x[first] @ x[far].T >= share - 1e-9)
                i, j = first[i], far[j]
                if not other[s]:
                    i, j = i[i < j], j[i < j]
                if not len(i):
                    continue
                fine = (x[i] * x[j]).sum(axis=1) >= share
                i, j = i[fine], j[fine]
                if len(i):  # only in the first table that brings a pair together
                    some, back = np.unique(np.concatenate([i, j]), return_inverse=True)
                    h = buckets(x[some], k, tables, width, seed)[:, : int(tab[s])]
                    p, q = back[: len(i)], back[len(i) :]
                    new = np.concatenate([~(h[p[z : z + 2000]] == h[q[z : z + 2000]]).any(axis=1) for z in range(0, len(p), 2000)])
                    pairs_a.append(i[new] + s)
                    pairs_b.append(j[new] + s)
            if not pairs_a:
                continue
            a, b = np.concatenate(pairs_a), np.concatenate(pairs_b)
            if not len(a):
                continue
            who, back = np.unique(np.concatenate([ids[a], ids[b]]), return_inverse=True)
            links = np.bincount(back, weights=np.concatenate([times[b], times[a]])).astype(np.int64)
            forest = next(local_forest([pa.RecordBatch.from_arrays([pa.array(ids[a]), pa.array(ids[b])], names=["a", "b"])]))
            up = dict(zip(forest.column(0).to_pylist(), forest.column(1).to_pylist(), strict=True))
            yield pa.RecordBatch.from_arrays([pa.array(who), pa.array(links), pa.array([up.get(w, w) for w in who.tolist()], pa.int64())], names=["id", "links", "up"])

    return run


def near_vectors(vectors: DataFrame, share: float = SHARE, width: float = WIDTH, recall: float = RECALL, block: int = BLOCK, seed: int = SEED, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every row.

    Rows whose vector is null, empty, zero or holds null or non-finite components link with nothing;
    vectors of different lengths are unrelated. Rows that repeat an id are rows of their own and
    have equal vectors counted as links; null ids come out as they are, alone in their component
    unless a copy has an id. An empty table gives an empty result; other columns are ignored.
    """
    spark = vectors.sparkSession
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vec_col).cast("array<double>").alias("v"))
    bad = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    good = F.coalesce(~bad & F.exists("v", lambda x: x != 0), F.lit(False))
    rows = rows.withColumn("v", F.when(good, F.transform("v", lambda x: x + F.lit(0.0))))
    ones = rows.filter("v is not null and vec_id is not null").groupBy("v").agg(F.min("vec_id").alias("id"), F.count("*").alias("times"))
    # one vector stands for its copies under the smallest id that a copy has; ids may repeat
    ones = stored(ones.groupBy("id", "v").agg(F.sum("times").alias("times")), "vectors")
    k, tables = plan(ones.count(), share, width, recall)
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)
    dealt = ones.select("id", "v").mapInArrow(_deal(k, tables, width, seed), "bucket long, tab int, id long")
    met = dealt.repartition(parts, "bucket").mapInArrow(_shared, "bucket long, tab int, id long, k long")
    met = met.withColumn("nb", F.ceil(F.col("k") / block)).withColumn("at", F.pmod(F.xxhash64("id"), F.col("nb")))
    met = met.withColumn("with", F.explode(F.sequence(F.lit(0).cast("long"), F.col("nb") - 1)))
    lo, hi = F.least("at", "with"), F.greatest("at", "with")
    met = met.select("bucket", "tab", lo.alias("lo"), hi.alias("hi"), "id", F.when(F.col("at") == lo, 0).otherwise(1).alias("side"), (hi - lo).alias("other"))
    met = met.join(ones, "id").repartition(parts, "bucket", "lo", "hi").sortWithinPartitions("bucket", "lo", "hi")
    links = met.mapInArrow(_compare(share, k, tables, width, seed), "id long, links long, up long")
    links = stored(links, "vector-links")
    count = links.groupBy("id").agg(F.sum("links").alias("links"))
    comp = components(links.select(F.col("id").alias("a"), F.col("up").alias("b")), "vectors")
    place = ones.select("id", "v", "times").join(count, "id", "left").join(comp.withColumnRenamed("node", "id"), "id", "left")
    place = place.select("v", (F.coalesce("links", F.lit(0)) + F.col("times") - 1).alias("n"), F.coalesce("root", "id").alias("root"))
    out = rows.join(place, "v", "left")
    return out.select(
        "vec_id",
        F.when(F.col("vec_id").isNull(), 0).otherwise(F.coalesce("n", F.lit(0))).cast("long").alias("n_links"),
        F.when(F.col("vec_id").isNotNull(), F.coalesce("root", "vec_id")).alias("component_id"),
    ).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))


def op10_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
