"""Exact Jaccard self-join of shingle sets by universe partition and the pigeonhole principle.

Two sets with at least 80 hundredths in common differ in at most a ninth of their summed sizes. The
shingles of a set are dealt by hash to the segments of its size band. Of two sets that differ in at
most d places, one that holds more than d units has a segment in which the other one agrees with
it: a segment is worth one unit when it is compared as a whole, and two units when it is compared
together with its one-deletion neighbours (the subset less any one shingle), as then a single
difference is met too. How many segments a band has and which of them get neighbours is chosen from
the number of sets in the band by estimated cost (bands that end above 33 shingles: among schemes
without neighbours). Every set goes into the scheme of its band and, if
smaller partners can lie in the band below, into that one; empty segments are worth nothing. A set
with too few units, by an uneven deal, goes on to a second layer in which each shingle is a segment
of its own: its smallest ones are compared. Two such sets meet there, all others in the first.

Sets are compared as classes, so copies are one set wherever they occur. Sets that share a segment
meet in its bucket. A bucket is linked to its smallest set and, only where that leaves it in more
than one component, pair by pair across them. Links are verified exactly, on the texts.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.llm.common import binary_column, components, documents, hash_ranges, local_forest, mixed, offsets, ragged_index, row_blocks, stored, text_bytes, trimmed, with_key, word_ranges

WORDS, SHARE = 5, 80  # shingle length, hundredths of the union
SMALL = 16  # sets in a bucket, up to which the bucket is kept as one row
PART = 8 << 20  # bytes of texts whose signatures are held at once
BLOCK = 2000  # sets of one block of a bucket beyond that
COMMON = 0.05  # taken share of shingles that unrelated sets have in common, for the cost estimate
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
FACTORS = mixed(np.arange(1, 65, dtype=np.uint64)) | np.uint64(1)


def shingle_sets(data: np.ndarray, edges: np.ndarray, words: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """(row, shingle hash) of the distinct shingles, ordered by both; fewer words than a shingle make one."""
    data = LOWER[data]
    starts, ends, counts = word_ranges(data, edges)
    h = hash_ranges(data, starts, ends)
    row = np.repeat(np.arange(len(counts)), counts)
    with np.errstate(over="ignore"):
        sums = np.zeros(max(0, len(h) - words + 1), np.uint64)
        for j in range(words):
            sums += h[j : len(h) - words + 1 + j] * FACTORS[j]
        whole = row[words - 1 :] == row[: len(row) - words + 1] if len(h) >= words else np.zeros(0, bool)
        rows, hashes = [row[: len(sums)][whole]], [mixed(sums[whole])]
        first = offsets(counts)
        for n in range(1, words):
            few = np.flatnonzero(counts == n)
            if len(few):
                total = np.full(len(few), n, np.uint64) * FACTORS[40]
                for j in range(n):
                    total += h[first[few] + j] * FACTORS[j]
                rows.append(few)
                hashes.append(mixed(total))
    row, h = np.concatenate(rows), np.concatenate(hashes)
    order = np.lexsort((h, row))
    row, h = row[order], h[order]
    new = np.concatenate([[True], (row[1:] != row[:-1]) | (h[1:] != h[:-1])]) if len(row) else np.zeros(0, bool)
    return row[new], h[new]


def classes(row: np.ndarray, h: np.ndarray, n_rows: int) -> tuple[np.ndarray, np.ndarray]:
    """The size of each row's set and a 64-bit name of the set (0: empty)."""
    n = np.bincount(row, minlength=n_rows)
    out = np.zeros(n_rows, np.uint64)
    has = np.flatnonzero(n)
    if len(has):
        at = offsets(n)[has]
        with np.errstate(over="ignore"):
            a, b = np.add.reduceat(h, at), np.add.reduceat(mixed(h ^ FACTORS[41]), at)
            out[has] = mixed(mixed(a + n[has].astype(np.uint64)) ^ b)
        out[has[out[has] == 0]] = 1
    return n, out


class Scheme:
    """The segments of one band of sizes [low, high) and how many of them get one-deletion neighbours."""

    def __init__(self, low: int, high: int, sets: int, share: int):
        self.low, self.high = low, high
        need = self.units(high - 1, share)
        best = None
        for double in range(0, (need if high <= 33 else 0) + 1):
            segments = max(1, math.ceil(1.15 * need) + 3 - double) if need > 1 or double else 1
            if double > segments:
                break
            mean = 0.5 * (low + high - 1) / segments
            cost = segments + double * mean + sets * (double * mean * COMMON ** max(0.5, mean - 1) + (segments - double) * COMMON ** max(0.5, mean))
            if best is None or cost < best[0]:
                best = (cost, segments, double)
        _, self.segments, self.double = best

    @staticmethod
    def units(n: int, share: int) -> int:
        """One more than what a set of n can differ in from a set at least as large."""
        return (n + n * 100 // share) * (100 - share) // (100 + share) + 1


def bands(counts: dict[int, int], share: int) -> list[Scheme]:
    """Bands of doubling sizes up to the largest; ``counts``: sets by the bit length of their size."""
    return [Scheme(1 << (b - 1), 1 << b, counts.get(b, 0), share) for b in range(1, max(counts, default=1) + 1)]


def signatures(row: np.ndarray, h: np.ndarray, n: np.ndarray, schemes: list[Scheme], share: int):
    """(owner row, in the band below?, spare units, signature) of the sets: arrays, for own band and the one below."""
    out = []
    sizes = n[row]
    bits = np.zeros(len(n), np.int64)
    bits[n > 0] = np.frexp(n[n > 0].astype(float))[1]
    for below in (False, True):
        for b, scheme in enumerate(schemes, 1):
            low = scheme.low
            if below:  # sets of the next band with partners in this one
                mine = (bits == b + 1) & (n * share <= (scheme.high - 1) * 100)
            else:
                mine = bits == b
            pick = mine[row]
            if not pick.any():
                continue
            r, x, size = row[pick], h[pick], sizes[pick]
            need = np.zeros(len(n), np.int64)
            if below:
                need[mine] = (scheme.high - 1 + n[mine]) * (100 - share) // (100 + share) + 1
            else:
                need[mine] = (n[mine] + n[mine] * 100 // share) * (100 - share) // (100 + share) + 1
            salt = mixed(np.array([low], np.uint64) ^ FACTORS[42])[0]
            y = mixed(x ^ salt)
            seg = (y % np.uint64(scheme.segments)).astype(np.int64)
            order = np.argsort(r * scheme.segments + seg)
            r, y, seg = r[order], mixed(y[order]), seg[order]
            heads = np.flatnonzero(np.concatenate([[True], (r[1:] != r[:-1]) | (seg[1:] != seg[:-1])]))
            count = np.diff(np.append(heads, len(r)))
            with np.errstate(over="ignore"):
                total = np.add.reduceat(y, heads)
                tag = mixed(seg[heads].astype(np.uint64) * FACTORS[43] + salt)
                unit = np.where((seg[heads] < scheme.double) & (count > 1), 2, 1)
                owner = r[heads]
                units = np.bincount(owner, weights=unit, minlength=len(n)).astype(np.int64)
                spare = (units - need) // (2 if scheme.double else 1)
                parts = [(owner, mixed(total ^ tag))]
                two = np.repeat(unit == 2, count)
                if two.any():
                    run = np.repeat(np.arange(len(heads)), count)[two]
                    parts.append((r[two], mixed((total[run] - y[two]) ^ tag[run])))
                short = (spare < 0) & mine
                if short.any():  # layer two: the smallest shingles, one by one
                    order = np.lexsort((y, r))
                    r2, y2 = r[order], y[order]
                    start = np.searchsorted(r2, np.arange(len(n)))
                    rank = np.arange(len(r2)) - start[r2]
                    take = short[r2] & (rank < need[r2])
                    parts.append((r2[take], mixed(y2[take] + FACTORS[44])))
            for who, sig in parts:
                out.append((who, np.full(len(who), below), np.maximum(spare[who], 0), sig))
    if not out:
        return np.zeros(0, np.int64), np.zeros(0, bool), np.zeros(0, np.int64), np.zeros(0, np.uint64)
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))


def _sets_of(data, edges, words):
    """Blocks of rows with their sets: (first row, row, hash, sizes, names)."""
    for a, b in row_blocks(edges, 1 << 22):
        row, h = shingle_sets(data[edges[a] : edges[b]], edges[a : b + 1] - edges[a], words)
        n, name = classes(row, h, b - a)
        yield a, row, h, n, name


def _counts(row: np.ndarray, h: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Shingles by their hash's first bits, four to eight in a bin on average (at most 255 count), and the bins of each row."""
    bits = np.maximum(np.frexp(np.maximum(n, 1).astype(float))[1] - 3, 0)
    bins = np.where(n > 0, 1 << bits, 0)
    at = offsets(bins)
    cell = at[row] + (h >> np.uint64(1) >> (63 - bits[row]).astype(np.uint64)).astype(np.int64)
    return np.minimum(np.bincount(cell, minlength=int(at[-1])), 255).astype(np.uint8), bins


def _apart(x: bytes, y: bytes) -> int:
    """A number of places in which two sets differ at least, from their counts by bin."""
    x, y = np.frombuffer(x, np.uint8).astype(np.int64), np.frombuffer(y, np.uint8).astype(np.int64)
    if len(x) != len(y):
        if max(x.max(initial=0), y.max(initial=0)) == 255:
            return 0
        few = min(len(x), len(y))
        x, y = x.reshape(few, -1).sum(axis=1), y.reshape(few, -1).sum(axis=1)
    return int(np.abs(x - y).sum())


def _likely(share: int):
    """Pairs that sizes and counts by bin do not rule out."""

    def run(batches):
        for batch in batches:
            na, nb = (batch.column(i).to_numpy(zero_copy_only=False) for i in (2, 3))
            fine = 100 * np.minimum(na, nb) >= share * np.maximum(na, nb)
            ha, hb = batch.column(4), batch.column(5)
            for i in np.flatnonzero(fine).tolist():
                fine[i] = _apart(ha[i].as_py(), hb[i].as_py()) * (100 + share) <= (int(na[i]) + int(nb[i])) * (100 - share)
            keep = pa.array(fine)
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(keep), batch.column(1).filter(keep)], names=["a", "b"])

    return run


def _sizes(words):
    def run(batches):
        for batch in batches:
            data, edges = text_bytes(batch.column(2))
            parts = []
            for _, row, h, n, name in _sets_of(data, edges, words):
                parts.append((n, name, *_counts(row, h, n)))
            n, name, counts, bins = (np.concatenate(x) for x in zip(*parts, strict=True))
            hist = binary_column(counts, offsets(bins))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(n), pa.array(name.view(np.int64)), hist], names=["key", "doc_id", "n", "name", "hist"])

    return run


def _grouped(sig: np.ndarray, name: np.ndarray, alone: np.ndarray | None = None) -> np.ndarray:
    """An order by signature and then name. With ``alone``, signatures that occur once are left out unless it is set."""
    order = np.argsort(sig)
    s = sig[order]
    same = s[1:] == s[:-1]
    many = np.concatenate([same, [False]]) | np.concatenate([[False], same])
    at = np.flatnonzero(many)
    order[at] = order[at][np.lexsort((name[order[at]], s[at]))]
    return order if alone is None else order[many | (alone[order] > 0)]


def _blocks(words: int, schemes: list[Scheme], share: int, places: int, hot: int):
    """Signatures dealt to ``places``: one row for each place and batch. Those that more than ``hot`` sets of the batch have are spread."""

    def run(batches):
        for batch in batches:
            whole, cuts = text_bytes(batch.column(0))
            for first, last in row_blocks(cuts, PART):  # bounds what is held at once
                yield from dealt(whole[cuts[first] : cuts[last]], cuts[first : last + 1] - cuts[first])

    def dealt(data, edges):
        own: list = []
        for _, row, h, n, name in _sets_of(data, edges, words):
            own.append((name[(s := signatures(row, h, n, schemes, share))[0]].view(np.int64), *s[1:]))
        name, below, spare, sig = (np.concatenate(x) for x in zip(*own, strict=True))
        if not len(sig):
            return
        order = _grouped(sig, name)
        name, below, spare, sig = name[order], below[order], spare[order], sig[order]
        new = np.concatenate([[True], (sig[1:] != sig[:-1]) | (name[1:] != name[:-1])])
        name, below, spare, sig = name[new], below[new], spare[new], sig[new]
        heads = np.flatnonzero(np.concatenate([[True], sig[1:] != sig[:-1]]))
        count = np.diff(np.append(heads, len(sig)))
        many = np.repeat(count > hot, count)
        place = (np.where(many, mixed(sig ^ name.view(np.uint64)), sig) % np.uint64(places)).astype(np.int64)
        mark = sig[heads[count > hot]]
        # owners of the batch are numbered; a mark has the owner 0
        info = spare * 2 + below
        with np.errstate(over="ignore"):
            _, first, owner = np.unique(mixed(name.view(np.uint64)) + info.astype(np.uint64) * FACTORS[45], return_index=True, return_inverse=True)
        names, owner = np.stack([name[first], info[first]], axis=1), owner + 1
        kind = np.where(many, 1, 0).astype(np.uint8)
        place = np.concatenate([place, (mark % np.uint64(places)).astype(np.int64)])
        sig, owner = np.concatenate([sig, mark]), np.concatenate([owner, np.zeros(len(mark), np.int64)])
        kind = np.concatenate([kind, np.full(len(mark), 2, np.uint8)])
        order = np.argsort(place, kind="stable")
        place, sig, owner, kind = place[order], sig[order], owner[order], kind[order]
        cut = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1], [True]]))
        rows = []
        for a, b in zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True):
            used, local = np.unique(owner[a:b], return_inverse=True)
            table = np.zeros((len(used), 2), np.int64)
            table[used > 0] = names[used[used > 0] - 1]
            wide = "<u2" if len(used) < 65536 else "<u4"
            rows.append((int(place[a]), sig[a:b].tobytes(), local.astype(wide).tobytes(), table.tobytes(), kind[a:b].tobytes() if kind[a:b].any() else b""))
        yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows, strict=True), (pa.int64(), *[pa.binary()] * 4), strict=True)], names=["place", "sig", "owner", "names", "kind"])

    return run


def _buckets(hot: int):
    """Buckets of a partition: (members) of up to ``hot`` sets; (sig, name, spare, below) rows of larger ones."""

    def run(batches):
        sigs, names, meta, kinds = [], [], [], []
        for batch in batches:
            for s, o, t, k in zip(*(batch.column(i).to_pylist() for i in (1, 2, 3, 4)), strict=True):
                s = np.frombuffer(s, np.uint64)
                o = np.frombuffer(o, "<u2" if len(o) == 2 * len(s) else "<u4").astype(np.int64)
                t = np.frombuffer(t, np.int64).reshape(-1, 2)
                sigs.append(s)
                names.append(t[o, 0])
                meta.append(t[o, 1])
                kinds.append(np.frombuffer(k, np.uint8) if k else np.zeros(len(s), np.uint8))
        if not sigs:
            return
        sig, name, info, kind = (np.concatenate(x) for x in (sigs, names, meta, kinds))
        order = _grouped(sig, name, alone=kind)
        sig, name, info, kind = sig[order], name[order], info[order], kind[order]
        # the same set from several batches is one member; marks stay
        new = np.concatenate([[True], (sig[1:] != sig[:-1]) | (name[1:] != name[:-1]) | (kind[1:] != kind[:-1])])[: len(sig)]
        sig, name, info, kind = sig[new], name[new], info[new], kind[new]
        if not len(sig):
            return
        heads = np.flatnonzero(np.concatenate([[True], sig[1:] != sig[:-1]]))
        count = np.diff(np.append(heads, len(sig)))
        large = (count > hot) | (np.maximum.reduceat(kind, heads) > 0)
        out = np.repeat(large, count) & (kind != 2)
        for x in range(0, int(out.sum()), 200_000):
            pick = np.flatnonzero(out)[x : x + 200_000]
            yield pa.RecordBatch.from_arrays([pa.nulls(len(pick), pa.list_(pa.int64())), pa.array(sig[pick].view(np.int64)), pa.array(name[pick]), pa.array(info[pick])], names=["members", "sig", "name", "info"])
        small = np.flatnonzero(~large & (count > 1))
        if len(small):
            with np.errstate(over="ignore"):
                whole = np.add.reduceat(mixed(name.view(np.uint64)), heads)[small]
            small = small[np.unique(whole, return_index=True)[1]]
            for x in range(0, len(small), 50_000):
                part = small[x : x + 50_000]
                flat = name[ragged_index(heads[part], count[part])]
                lists = pa.ListArray.from_arrays(pa.array(offsets(count[part]).astype(np.int32)), pa.array(flat))
                none = pa.nulls(len(part), pa.int64())
                yield pa.RecordBatch.from_arrays([lists, none, none, none], names=["members", "sig", "name", "info"])

    return run


def _verify(words: int, share: int):
    def run(batches):
        for batch in batches:
            (da, ea), (db, eb) = text_bytes(batch.column(2)), text_bytes(batch.column(3))
            keep = []
            for a, b in row_blocks(ea + eb, 1 << 22):
                ra, ha = shingle_sets(da[ea[a] : ea[b]], ea[a : b + 1] - ea[a], words)
                rb, hb = shingle_sets(db[eb[a] : eb[b]], eb[a : b + 1] - eb[a], words)
                r, h = np.concatenate([ra, rb]), np.concatenate([ha, hb])
                order = np.lexsort((h, r))
                r, h = r[order], h[order]
                both = np.bincount(r[1:][(r[1:] == r[:-1]) & (h[1:] == h[:-1])], minlength=b - a)
                union = np.bincount(r, minlength=b - a) - both
                keep.append(100 * both >= share * union)
            keep = pa.array(np.concatenate(keep))
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(keep), batch.column(1).filter(keep)], names=["a", "b"])

    return run


def _set_bytes(words: int):
    def run(batches):
        for batch in batches:
            data, edges = text_bytes(batch.column(1))
            parts = [(h, n) for _, _, h, n, _ in _sets_of(data, edges, words)]
            column = binary_column(np.concatenate([h for h, _ in parts]), offsets(np.concatenate([n for _, n in parts])))
            yield pa.RecordBatch.from_arrays([batch.column(0), column], names=["name", "shingles"])

    return run


def _between_blocks(share: int):
    """Verified links between two blocks of a family (or within one) across components, as a forest."""

    def run(table: pa.Table) -> pa.Table:
        name, root, side = (table.column(c).to_numpy() for c in ("name", "root", "side"))
        none = pa.table({"a": pa.array([], pa.int64()), "b": pa.array([], pa.int64())})
        if len(np.unique(root)) < 2:
            return none
        order = np.lexsort((name, root))
        sets = [np.frombuffer(x, np.uint64) for x in table.column("shingles").take(pa.array(order)).to_pylist()]
        name, root, side = name[order], root[order], side[order]
        n = np.array([len(x) for x in sets])
        own = np.flatnonzero(side == 0)
        far = np.flatnonzero(side == 1) if int(table.column("other")[0].as_py()) else own
        # shingles that one set alone has can't be shared
        values, column, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
        row = np.repeat(np.arange(len(sets)), n)
        common = count[column] > 1
        place = np.cumsum(count > 1) - 1
        row, column, width = row[common], place[column[common]], int((count > 1).sum())
        found = [pa.RecordBatch.from_arrays([pa.array([], pa.int64())] * 2, names=["a", "b"])]
        for x in range(0, len(own), 256):
            part = own[x : x + 256]
            other = far[root[far] != root[part[0]]] if (root[part] == root[part[0]]).all() else far
            if not len(other):
                continue
            both = np.zeros((len(part), len(other)), np.float32)
            at_part, at_other = np.full(len(sets), -1), np.full(len(sets), -1)
            at_part[part], at_other[other] = np.arange(len(part)), np.arange(len(other))
            for c in range(0, width, 8192):  # counts of shared shingles, exact in single precision
                here = (column >= c) & (column < c + 8192)
                r, q = row[here], column[here] - c
                left, right = np.zeros((len(part), min(8192, width - c)), np.float32), np.zeros((len(other), min(8192, width - c)), np.float32)
                mine, theirs = at_part[r] >= 0, at_other[r] >= 0
                left[at_part[r[mine]], q[mine]] = 1
                right[at_other[r[theirs]], q[theirs]] = 1
                both += left @ right.T
            both = both.astype(np.int64)
            fine = (100 * both >= share * (n[part][:, None] + n[other] - both)) & (root[part][:, None] != root[other])
            i, j = np.nonzero(fine)
            a = np.concatenate([found[0].column(0).to_numpy(), name[part[i]]])
            b = np.concatenate([found[0].column(1).to_numpy(), name[other[j]]])
            if len(a):
                found = list(local_forest([pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])]))
        return pa.Table.from_batches(found) if len(found[0]) else none

    return run


def link(docs: DataFrame, words: int = WORDS, share: int = SHARE, small: int = SMALL, block: int = BLOCK, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(key, doc_id, n_shingles, root, component_id): the connected components of all documents.

    Null and empty texts, and texts without words, have the empty set and stay alone. Rows that
    repeat an id are told apart by their texts (see with_key()); a component carries its smallest id
    (null counts as the smallest). Other columns are ignored; an empty table gives an empty result.
    """
    spark = docs.sparkSession
    texts = with_key(docs, id_col, text_col)
    rows = stored(texts.select("key", "doc_id", "text").mapInArrow(trimmed(_sizes(words)), "key long, doc_id long, n long, name long, hist binary"), "jaccard-sets")
    sets = rows.filter("n > 0").groupBy("name").agg(F.min("key").alias("rep"), F.first("n").alias("n"), F.first("hist").alias("hist"))
    by_band = sets.groupBy(F.floor(F.log2(F.col("n") + 0.5) + 1).cast("int").alias("b")).count().collect()  # as many rows as sizes have bits
    schemes = bands({r["b"]: r["count"] for r in by_band}, share)
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)
    dealt = texts.select("text").mapInArrow(trimmed(_blocks(words, schemes, share, parts, small)), "place long, sig binary, owner binary, names binary, kind binary")
    found = dealt.repartitionById(parts, F.col("place").cast("int")).mapInArrow(trimmed(_buckets(small)), "members array<long>, sig long, name long, info long")
    found = stored(found, "jaccard-buckets")
    groups = stored(found.filter("members is not null").select("members").distinct(), "jaccard-groups")
    large = found.filter("members is null").select("sig", "name", F.floor(F.col("info") / 2).alias("spare"), (F.col("info") % 2 != 0).alias("below"))
    # first each set with the smallest one that it meets
    heads = large.groupBy("sig").agg(F.min("name").alias("a"))
    star = groups.select(F.col("members")[0].alias("a"), F.explode("members").alias("b"))
    star = star.union(large.join(heads, "sig").select("a", F.col("name").alias("b")))
    star = stored(star.groupBy("b").agg(F.min("a").alias("a")).filter("a <> b").select("a", "b"), "jaccard-star")
    # the texts of the sets that met another one
    met = groups.select(F.explode("members").alias("name")).union(large.select("name")).distinct().join(sets, "name")
    met = stored(met.select("name", F.col("rep").alias("key"), "n", "hist"), "jaccard-met")
    some = stored(texts.select("key", "text").join(met.select("name", "key"), "key").dropDuplicates(["name"]).select("name", "text"), "jaccard-texts")

    def verified(pairs: DataFrame, step: str) -> DataFrame:
        side = lambda x: met.select(F.col("name").alias(x), F.col("n").alias(f"n{x}"), F.col("hist").alias(f"h{x}"))
        pairs = pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "na", "nb", "ha", "hb")
        pairs = stored(pairs.mapInArrow(trimmed(_likely(share)), "a long, b long"), f"{step}-likely")
        left, right = some.select(F.col("name").alias("a"), F.col("text").alias("ta")), some.select(F.col("name").alias("b"), F.col("text").alias("tb"))
        pairs = pairs.join(left, "a").join(right, "b").select("a", "b", "ta", "tb")
        return stored(pairs.mapInArrow(trimmed(_verify(words, share)), "a long, b long"), step)

    links = verified(star, "jaccard-links")
    reps = sets.select("name", "rep")

    def roots(links: DataFrame) -> DataFrame:
        a, b = reps.select(F.col("name").alias("a"), F.col("rep").alias("ra")), reps.select(F.col("name").alias("b"), F.col("rep").alias("rb"))
        return components(links.join(a, "a").join(b, "b").select(F.col("ra").alias("a"), F.col("rb").alias("b")), "jaccard")

    comp = roots(links)
    named = some.select("name").join(reps, "name").join(comp.withColumnRenamed("node", "rep"), "rep", "left").select("name", F.coalesce("root", "rep").alias("root"))
    named = stored(named, "jaccard-roots")
    # buckets that are still in more than one component: every pair across them
    each = groups.withColumn("g", F.xxhash64("members")).select("g", "members", F.posexplode("members").alias("i", "name"))
    torn = each.join(named, "name").groupBy("g", "members").agg(F.min("root").alias("x"), F.max("root").alias("y"), F.map_from_entries(F.collect_list(F.struct("name", "root"))).alias("of")).filter("x < y")
    rest = torn.select("of", "members", F.posexplode("members").alias("i", "a")).select("of", "a", F.explode(F.expr("slice(members, i + 2, size(members))")).alias("b")).filter("of[a] <> of[b]").select("a", "b")
    more = rest.distinct()
    # large buckets: only sets whose units in smaller ones do not suffice need them
    needy = large.groupBy("name", "below").agg(F.count("*").alias("lost"), F.min("spare").alias("spare")).filter("lost > spare").select("name").distinct()
    left = large.select("sig", "name").distinct().join(needy, "name").join(named, "name")
    torn2 = left.groupBy("sig").agg(F.min("root").alias("x"), F.max("root").alias("y")).filter("x < y").select("sig")
    left = stored(left.join(torn2, "sig"), "jaccard-torn")
    more = stored(more.join(star, ["a", "b"], "left_anti"), "jaccard-more")
    again = not more.isEmpty()
    if again:
        links = links.union(verified(more, "jaccard-links2"))
    if not left.isEmpty():
        # sets that share large buckets directly or through others are a family; each pair of it is met once, in blocks
        again = True
        heads = left.groupBy("sig").agg(F.min("name").alias("b"))
        family = components(left.join(heads, "sig").select(F.col("name").alias("a"), "b"), "jaccard-family").toDF("name", "family")
        member = left.select("name", "root").distinct().join(family, "name").select("name", "family", "root")
        blocks = member.groupBy("family").agg(F.ceil(F.count("*") / block).alias("nb"))
        shingles = some.join(member.select("name"), "name").select("name", "text").mapInArrow(trimmed(_set_bytes(words)), "name long, shingles binary")
        member = stored(member.join(blocks, "family").join(shingles, "name"), "jaccard-members")
        member = member.withColumn("at", F.pmod(F.xxhash64("name"), F.col("nb"))).withColumn("with", F.explode(F.sequence(F.lit(0).cast("long"), F.col("nb") - 1)))
        lo, hi = F.least("at", "with"), F.greatest("at", "with")
        member = member.select("family", lo.alias("lo"), hi.alias("hi"), "name", "root", "shingles", F.when(F.col("at") == lo, 0).otherwise(1).alias("side"), (hi - lo).alias("other"))
        far = member.groupBy("family", "lo", "hi").applyInArrow(_between_blocks(share), "a long, b long")
        links = links.union(stored(far, "jaccard-links3"))
    if again:
        comp = roots(links)
    out = rows.select("key", "doc_id", F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("name")).alias("name"))
    place = reps.join(comp.withColumnRenamed("node", "rep"), "rep", "left").select("name", F.coalesce("root", "rep").alias("root"))
    out = out.join(place, "name", "left").select("key", "doc_id", "n_shingles", F.coalesce("root", "key").alias("root"))
    # the id of the smallest document; ids are keys unless ids repeat or are null
    ids = rows.filter("not key <=> doc_id").select(F.col("key").alias("root"), F.col("doc_id").alias("id"), F.lit(True).alias("odd")).distinct()
    out = out.join(ids, "root", "left")
    return out.select("key", "doc_id", "n_shingles", "root", F.when(F.col("odd"), F.col("id")).otherwise(F.col("root")).alias("component_id"))


def op4_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return link(documents(spark, sf_dir)).select("doc_id", "n_shingles", "component_id")
