"""Toxicity by the nearest labelled examples, found exactly with block-max inverted indexes.

Terms are lower-cased words and the first four to seven letters of longer ones; the dictionary holds those
that the labelled examples tie to toxic texts, and one term for any word, so that a text's vector also
tells how much else stands in it. Weights are (1 + ln tf) * idf with idf over all documents,
vectors have length one. Examples with the same vector are one entry that knows how many they are
and how many of them are toxic.

Entries are dealt into blocks; for each term and block the index keeps the largest weight, which
bounds the cosine of any entry of the block. Blocks are opened by falling bound until no other can
hold one of the nearest. The nearest vote with weights that fall with the distance, drawn a little to the base rate.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.llm.alignment import Growing
from ledgerlake.llm.common import Words, documents, held, letter_sign_cuts, offsets, ragged_index, row_blocks, stored, text_bytes, trimmed, word_ranges
from ledgerlake.llm.quality import remainder

SAMPLE, TERMS, NEAREST, SEED = 6000, 4096, 16, 13
STEMS = (4, 5, 6, 7)
LEAST = 3  # examples that hold a term of the dictionary
BLOCK, OPEN = 32, 8
NEAR, PULL = 0.02, 0.5  # distance at which a vote counts half; weight of the base rate
SLACK = 1e-12
THRESHOLD = 0.3
KNOWN = 400_000
SPAN = 1 << 20

WORD = re.compile(r"[^\W\d_]+")


def terms(word: str) -> list[str]:
    """A lower-cased word and its stems, which end in a star."""
    return [word, *(f"{word[:k]}*" for k in STEMS if len(word) > k)]


def words(text: str) -> list[str]:
    return [w.lower() for w in WORD.findall(text)]


class Counts(Words):
    """For chunks between white space: the numbers of their terms in the dictionary and how many words they have."""

    def __init__(self, dictionary: dict[str, int]):
        self.dictionary = dictionary
        super().__init__(self._terms, KNOWN)

    def reset(self) -> None:
        super().reset()
        self.words = Growing(np.int64)

    def _terms(self, keys: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        get, out, n = self.dictionary.get, [], []
        for key in keys:
            found = words(key.decode("utf-8", "replace"))
            n.append(len(found))
            out.append([k for w in found for t in terms(w) if (k := get(t)) is not None])
        self.words.add(np.array(n, np.int64))
        lens = np.fromiter(map(len, out), np.int64, len(out))
        return np.fromiter(chain.from_iterable(out), np.int64, int(lens.sum())), lens

    def of(self, data: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(how many terms each text holds, the terms ascending, their counts); the last term of all is any word."""
        size = len(self.dictionary) + 1
        starts, ends, counts = word_ranges(data, edges, more=letter_sign_cuts(data))
        numbers = self.number(data, starts, ends)
        flat, lens = self.values(numbers)
        doc = np.repeat(np.arange(len(counts)), counts)
        some, times = np.unique(np.repeat(doc, lens) * size + flat, return_counts=True)
        all_words = np.diff(offsets(self.words.data[numbers])[offsets(counts)]) if len(numbers) else np.zeros(len(counts), np.int64)
        has = np.flatnonzero(all_words)
        some, times = np.concatenate([some, has * size + size - 1]), np.concatenate([times, all_words[has]])
        order = np.argsort(some)
        some, times = some[order].astype(np.int64), times[order]
        return np.bincount(some // size, minlength=len(counts)), some % size, times


def _texts(batch: pa.RecordBatch, column: int, counter: Counts):
    data, edges = text_bytes(batch.column(column))
    for a, b in row_blocks(edges, SPAN):
        yield a, b, *counter.of(data[edges[a] : edges[b]], edges[a : b + 1] - edges[a])


class BlockMax:
    """An inverted index over sparse vectors of length one."""

    def __init__(self, lens: np.ndarray, ids: np.ndarray, weights: np.ndarray, size: int, block: int = BLOCK):
        n = len(lens)
        at = offsets(lens)
        row = np.repeat(np.arange(n), lens)
        # entries with the same heaviest terms stand together, so that blocks have tight bounds
        heaviest = np.lexsort((ids, -weights, row))[at[:-1][lens > 0]]
        lead = np.full(n, size)
        lead[lens > 0] = ids[heaviest]
        weight = np.zeros(n)
        weight[lens > 0] = weights[heaviest]
        self.order = np.lexsort((weight, lead))
        place = np.empty(n, np.int64)
        place[self.order] = np.arange(n)
        self.n, self.block, self.blocks = n, block, max(1, -(-n // block))
        spot = place[row]
        post = np.lexsort((spot, ids))
        self.spot, self.weight = spot[post], weights[post]
        cell = ids[post] * self.blocks + self.spot // block
        self.starts = np.searchsorted(cell, np.arange(size * self.blocks + 1))
        self.top = np.zeros(size * self.blocks)
        np.maximum.at(self.top, cell, self.weight)
        self.top = self.top.reshape(size, self.blocks)

    def nearest(self, ids: np.ndarray, weights: np.ndarray, count: np.ndarray, k: int = NEAREST) -> tuple[np.ndarray, np.ndarray]:
        """(entries, cosines) of the nearest that stand for ``k`` examples by ``count``, by falling cosine; ties at the end are all in.

        Only entries with a cosine above zero are found.
        """
        bound = weights @ self.top[ids]
        rank = np.argsort(-bound, kind="stable")
        found, cosine, least = [], [], 0.0
        for s in range(0, self.blocks, OPEN):
            take = rank[s : s + OPEN]
            take = take[(bound[take] > 0) & (bound[take] >= least - SLACK)]
            if not len(take):
                break
            cells = (ids[:, None] * self.blocks + take).ravel()
            lens = self.starts[cells + 1] - self.starts[cells]
            post = ragged_index(self.starts[cells], lens)
            spots, back = np.unique(self.spot[post], return_inverse=True)
            value = np.bincount(back, weights=self.weight[post] * np.repeat(np.repeat(weights, len(take)), lens))
            found.append(spots)
            cosine.append(value)
            where, all_cos = np.concatenate(found), np.concatenate(cosine)
            best = np.argsort(-all_cos, kind="stable")
            enough = np.searchsorted(np.cumsum(count[self.order[where[best]]]), k)
            least = all_cos[best[enough]] if enough < len(best) else 0.0
            keep = all_cos >= least - SLACK
            found, cosine = [where[keep]], [all_cos[keep]]
        if not found:
            return np.zeros(0, np.int64), np.zeros(0)
        where, all_cos = self.order[found[0]], np.minimum(cosine[0], 1.0)
        best = np.lexsort((where, -all_cos))
        return where[best], all_cos[best]


@dataclass
class Model:
    """The dictionary, the weights of its terms (the last is any word) and the index of the examples."""

    dictionary: dict[str, int]
    idf: np.ndarray
    index: BlockMax | None
    count: np.ndarray  # examples of an entry
    toxic: np.ndarray  # toxic ones among them
    doc_id: np.ndarray  # the smallest id among them
    base: float
    empty: tuple[int, int] = (0, 0)  # examples without any word, and toxic ones
    known: dict = field(default_factory=dict)

    def vectors(self, lens: np.ndarray, ids: np.ndarray, times: np.ndarray) -> np.ndarray:
        """Weights of length one for each text."""
        w = (1 + np.log(times)) * self.idf[ids]
        row = np.repeat(np.arange(len(lens)), lens)
        norm = np.sqrt(np.bincount(row, weights=w * w, minlength=len(lens)))
        return w / norm[row]

    def judged(self, ids: np.ndarray, weights: np.ndarray) -> tuple[float, list[tuple[int, float, int, int]]]:
        """(score, evidence: id, cosine, examples, toxic ones)."""
        if self.index is None:
            return 0.0, []
        if not len(ids):
            n, y = self.empty
            return (y + PULL * self.base) / (n + PULL), []
        entry, cosine = self.index.nearest(ids, weights, self.count)
        w = NEAR / (NEAR + 1 - cosine)
        score = (float((w * self.toxic[entry]).sum()) + PULL * self.base) / (float((w * self.count[entry]).sum()) + PULL)
        return min(score, 1.0), list(zip(self.doc_id[entry].tolist(), cosine.tolist(), self.count[entry].tolist(), self.toxic[entry].tolist(), strict=True))


def _associated(sample: DataFrame, most: int) -> dict[str, int]:
    """The terms of the dictionary: held by some examples, more of the toxic ones than chance would give (likelihood ratio)."""

    def run(batches):
        seen: dict[str, list[int]] = {}

        def out():
            names = list(seen)
            return pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array([seen[t][1] for t in names], pa.int64()), pa.array([seen[t][0] for t in names], pa.int64())], names=["term", "bad", "good"])

        for batch in batches:
            for text, y in zip(batch.column(0), batch.column(1).to_pylist(), strict=True):
                for t in {t for w in set(words(text.as_py() or "")) for t in terms(w)}:
                    seen.setdefault(t, [0, 0])[y] += 1
                if len(seen) > 200_000:
                    yield out()
                    seen.clear()
        yield out()

    each = sample.select("t", "y").mapInArrow(trimmed(run), "term string, bad long, good long").groupBy("term").agg(F.sum("bad").alias("bad"), F.sum("good").alias("good"))
    each = stored(each, "toxic-terms")
    size = sample.agg(F.coalesce(F.sum("y"), F.lit(0)).alias("bad"), F.count("*").alias("n")).first()
    bad_n, good_n = float(size["bad"]), float(size["n"] - size["bad"])
    if not bad_n or not good_n:
        return {}
    n, held_by = bad_n + good_n, F.col("bad") + F.col("good")
    parts = [(F.col("bad"), held_by * bad_n / n), (F.col("good"), held_by * good_n / n), (bad_n - F.col("bad"), (n - held_by) * bad_n / n), (good_n - F.col("good"), (n - held_by) * good_n / n)]
    ratio = sum(F.when(o > 0, 2 * o * F.log(o / e)).otherwise(0.0) for o, e in parts)
    chance = 2 * np.log(max(each.count(), 2))  # as large as the largest of so many by chance
    got = each.filter((held_by >= LEAST) & (F.col("bad") * good_n > F.col("good") * bad_n)).withColumn("ratio", ratio)
    got = got.filter(F.col("ratio") > float(chance)).orderBy(F.desc("ratio"), "term").limit(most).collect()
    # a stem says nothing new beside a longer term that the same number of texts hold
    same: dict[tuple[int, int], list[str]] = {}
    for r in got:
        same.setdefault((r["bad"], r["good"]), []).append(r["term"])
    keep = [t for ts in same.values() for t in ts if not (t.endswith("*") and any(u != t and u.startswith(t[:-1]) and len(u.rstrip("*")) + (u[-1] != "*") > len(t) - 1 for u in ts))]
    return {t: k for k, t in enumerate(sorted(keep))}


def _counter(dictionary: dict[str, int], name: str) -> Counts:
    return held(name, lambda: Counts(dictionary))


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, most: int = TERMS, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> Model:
    """The index of at most ``sample`` labelled documents, chosen by a hash of their ids, with a dictionary of at most ``most`` terms.

    idf counts all documents. Labels that are null are left out, a document labelled twice is toxic
    if one label says so; rows that repeat an id are examples of their own. Without labelled documents all scores are 0.
    """
    spark = docs.sparkSession
    marked = labels.filter(F.col(label_col).isNotNull() & F.col(id_col).isNotNull()).groupBy(F.col(id_col).cast("long").alias("i")).agg(F.max(label_col).cast("int").alias("y"))
    marked = marked.orderBy(F.xxhash64("i", F.lit(SEED)), "i").limit(sample)
    rows = docs.select(F.col(id_col).cast("long").alias("i"), F.col(text_col).alias("t"))
    picked = stored(rows.join(F.broadcast(marked), "i").select("i", "t", (F.col("y") > 0).cast("int").alias("y")), "toxic-examples")
    dictionary = _associated(picked, most)
    size = len(dictionary) + 1
    name = f"toxic terms {abs(hash(tuple(dictionary)))}"
    shared = spark.sparkContext.broadcast(dictionary)

    def frequencies(batches):
        counter, total, n = _counter(shared.value, name), np.zeros(size, np.int64), 0
        for batch in batches:
            for a, b, _, ids, _ in _texts(batch, 0, counter):
                total += np.bincount(ids, minlength=size)
                n += b - a
        at = np.append(np.flatnonzero(total), size)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(np.append(total[at[:-1]], n))], names=["at", "docs"])

    held_by = np.zeros(size + 1)
    for r in rows.select("t").mapInArrow(trimmed(frequencies, name), "at long, docs long").groupBy("at").agg(F.sum("docs").alias("docs")).collect():
        held_by[r["at"]] = r["docs"]
    idf = 1 + np.log((1 + held_by[-1]) / (1 + held_by[:-1]))

    def count(batches):
        counter = _counter(shared.value, name)
        for batch in batches:
            for a, b, lens, ids, times in _texts(batch, 1, counter):
                lists = lambda x, lens=lens: pa.ListArray.from_arrays(pa.array(offsets(lens).astype(np.int32)), pa.array(x.astype(np.int64)))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), batch.column(2).slice(a, b - a), lists(ids), lists(times)], names=["i", "y", "ids", "times"])

    entries: dict[tuple, list[int]] = {}
    examples = picked.select("i", "t", "y").mapInArrow(trimmed(count, name), "i long, y int, ids array<long>, times array<long>").collect()
    for r in examples:  # at most ``sample`` documents, of at most ``most`` terms each
        e = entries.setdefault((tuple(r["ids"]), tuple(r["times"])), [0, 0, r["i"]])
        e[0] += 1
        e[1] += r["y"]
        e[2] = min(e[2], r["i"])
    empty = entries.pop(((), ()), [0, 0, 0])
    keys = sorted(entries)
    lens = np.array([len(k[0]) for k in keys], np.int64)
    ids = np.fromiter(chain.from_iterable(k[0] for k in keys), np.int64, int(lens.sum()))
    times = np.fromiter(chain.from_iterable(k[1] for k in keys), np.int64, int(lens.sum()))
    n, y, first = (np.array([entries[k][j] for k in keys], np.int64) for j in range(3))
    base = (float(y.sum()) + empty[1]) / max(1, int(n.sum()) + empty[0])
    model = Model(dictionary, idf, None, n, y, first, base, (empty[0], empty[1]))
    if examples:
        model.index = BlockMax(lens, ids, model.vectors(lens, ids, times), size)
    return model


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, score, evidence) of every whole text; null is empty and, like a text without words, gets the rate of such examples.

    ``evidence`` lists the entries that voted: the smallest id of the examples, their cosine, how many
    they are and how many are toxic. Rows are independent, equal texts get equal scores, an empty
    table gives an empty result, other columns are ignored.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    name = f"toxic terms {abs(hash(tuple(model.dictionary)))}"

    def run(batches):
        m = shared.value
        counter = _counter(m.dictionary, name)
        for batch in batches:
            for a, b, lens, ids, times in _texts(batch, 1, counter):
                weights, at = m.vectors(lens, ids, times), offsets(lens).tolist()
                out = []
                for s, e in zip(at[:-1], at[1:], strict=True):
                    if e - s < 2:  # nothing of the dictionary but perhaps any word
                        key = e - s
                        if key not in m.known:
                            m.known[key] = m.judged(ids[s:e], weights[s:e])
                        out.append(m.known[key])
                    else:
                        out.append(m.judged(ids[s:e], weights[s:e]))
                sizes = offsets(np.array([len(e) for _, e in out], np.int64))
                flat = [x for _, e in out for x in e]
                kinds = (("doc_id", pa.int64()), ("cosine", pa.float64()), ("examples", pa.int64()), ("toxic", pa.int64()))
                struct = pa.StructArray.from_arrays([pa.array([x[j] for x in flat], kind) for j, (_, kind) in enumerate(kinds)], names=[k for k, _ in kinds])
                evidence = pa.ListArray.from_arrays(pa.array(sizes.astype(np.int32)), struct)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), pa.array([s for s, _ in out]), evidence], names=["doc_id", "score", "evidence"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("t"))
    return rows.mapInArrow(trimmed(run, name), "doc_id long, score double, evidence array<struct<doc_id:long,cosine:double,examples:long,toxic:long>>")


def op13_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    out = score(docs, train(docs, labels.filter(remainder(4) != 2)))
    return out.select("doc_id", F.coalesce(remainder(4) == 2, F.lit(False)).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"), "evidence")
