"""Languages of documents by multilingual mixture inference.

A language is a distribution over byte trigrams of lower-case words with their borders, counted over
all labelled documents. A text is a mixture: each of its words comes from one of its languages.
Expectation-maximisation estimates the proportions from the words' likelihoods. All sets of languages
are compared by their likelihood less a penalty for each language, and the answer is the language with
the largest proportion in the best set (ties: the smaller set, then the first by name), with that
proportion as its score. The likelihood is concave in the proportions, so every round also gives the
most that a set can reach: a set is left when that can't beat the best one, and is settled when it is
within TOLERANCE. Where more than AMONG languages were learned, the sets of a text are made of the
AMONG with the largest proportions in the mixture of all.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.llm.common import SPAN, Words, documents, map_arrow, offsets, ragged_index, row_blocks, text_bytes, word_ranges

BITS = 16  # trigrams are hashed to 2**BITS counters
ROUNDS, TOLERANCE, PENALTY, AMONG = 1000, 1e-3, 6.0, 8
SEPARATORS = np.zeros(256, bool)
SEPARATORS[[c for c in range(128) if not chr(c).isalpha()]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def trigrams(keys: list[bytes], bits: int = BITS) -> tuple[np.ndarray, np.ndarray]:
    """The counters of each word's trigrams: a border, the word, a border."""
    size = np.fromiter(map(len, keys), np.int64, len(keys))
    data = np.frombuffer(b"\n" + b"\n\n".join(keys) + b"\n", np.uint8).astype(np.uint32)
    gram = (data[:-2] * np.uint32(65536) + data[1:-1] * np.uint32(256) + data[2:]) * np.uint32(2654435761) >> np.uint32(32 - bits)
    # a word of n letters has n trigrams: they begin at its border and at its letters but the last
    pick = ragged_index(np.cumsum(size + 2) - size - 2, size)
    return gram[pick].astype(np.int64), size


def _words(data: np.ndarray, edges: np.ndarray):
    data = LOWER[data]
    return data, *word_ranges(data, edges, SEPARATORS)


def counts_by_language(docs: DataFrame, lang_col: str = "lang", text_col: str = "text", bits: int = BITS) -> DataFrame:
    """(lang, gram, n) over all documents with a language; batches count into tables of fixed size."""

    def run(batches):
        table = Words(lambda keys: trigrams(keys, bits), 500_000)
        for batch in batches:
            langs = batch.column(0).to_pylist()
            data, edges = text_bytes(batch.column(1))
            names = sorted(set(langs))
            place = {x: i for i, x in enumerate(names)}
            total = np.zeros((len(names), 1 << bits), np.int64)
            for a, b in row_blocks(edges, SPAN):
                piece, starts, ends, counts = _words(data[edges[a] : edges[b]], edges[a : b + 1] - edges[a])
                grams, lens = table.values(table.number(piece, starts, ends))
                lang = np.repeat(np.repeat(np.array([place[x] for x in langs[a:b]], np.int64), counts), lens)
                total += np.bincount((lang << bits) + grams, minlength=total.size).reshape(total.shape)
            i, g = np.nonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array([names[x] for x in i.tolist()], pa.string()), pa.array(g), pa.array(total[i, g])], names=["lang", "gram", "n"])

    rows = docs.filter(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()).select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))


class Languages:
    """Log-likelihoods of trigrams by language."""

    def __init__(self, counts: dict[str, np.ndarray], bits: int = BITS):
        self.names, self.bits = sorted(counts), bits
        table = np.array([counts[x] for x in self.names], np.float64).reshape(len(self.names), 1 << bits)
        self.logs = np.log((table + 0.1) / (table.sum(axis=1, keepdims=True) + 0.1 * (1 << bits))).T.astype(np.float32)
        self.words: Words | None = None

    def __getstate__(self):
        return self.__dict__ | {"words": None}

    def _weigh(self, keys: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        grams, lens = trigrams(keys, self.bits)
        out = np.add.reduceat(self.logs[grams], np.cumsum(lens) - lens, axis=0).astype(np.float32)
        return out, np.ones(len(keys), np.int64)

    def infer(self, data: np.ndarray, edges: np.ndarray, penalty: float = PENALTY, among: int = AMONG) -> tuple[np.ndarray, np.ndarray]:
        """(index of the language, or -1 without words; score) of each text."""
        n_rows, k = len(edges) - 1, len(self.names)
        best, score = np.full(n_rows, -1), np.zeros(n_rows)
        if self.words is None:
            self.words = Words(self._weigh, 600_000)
        piece, starts, ends, counts = _words(data, edges)
        full = np.flatnonzero(counts)
        if not len(full) or not k:
            return best, score
        logs = self.words.values(self.words.number(piece, starts, ends))[0].astype(np.float64)
        best[full], score[full] = best_sets(logs, counts[full], penalty, among)
        return best, score


def best_sets(logs: np.ndarray, counts: np.ndarray, penalty: float = PENALTY, among: int = AMONG) -> tuple[np.ndarray, np.ndarray]:
    """(largest language of the best set, its proportion) of each text of ``counts`` words, from the words' log-likelihoods by language."""
    n, k = len(counts), logs.shape[1]
    alone = np.add.reduceat(logs, offsets(counts)[:-1], axis=0)
    choice, part = alone.argmax(axis=1), np.ones(n)
    gain = alone.max(axis=1) - penalty
    if k == 1:
        return choice, part
    # no set can do better than the mixture of all: texts that two languages can't pay for are done
    share = np.full((n, k), 0.1 / k)
    share[np.arange(n), choice] += 0.9
    share, _, most = mixture(logs, counts, share, gain + 2 * penalty)
    rows = np.flatnonzero(most > gain + 2 * penalty)
    if not len(rows):
        return choice, part
    take = np.zeros(n, bool)
    take[rows] = True
    cols = np.sort(np.argsort(-share[rows], axis=1, kind="stable")[:, :among], axis=1)
    logs, counts = np.take_along_axis(logs[np.repeat(take, counts)], np.repeat(cols, counts[rows], axis=0), axis=1), counts[rows]
    for size in range(2, cols.shape[1] + 1):
        for members in map(list, combinations(range(cols.shape[1]), size)):
            open_ = most[rows] > gain[rows] + size * penalty
            if not open_.any():
                return choice, part
            own, c, floor = logs[np.repeat(open_, counts)][:, members], counts[open_], gain[rows][open_] + size * penalty
            mixed, value, _ = mixture(own, c, np.full((len(c), size), 1 / size), floor)
            won = value > floor
            at = rows[open_][won]
            gain[at] = value[won] - size * penalty
            choice[at] = cols[open_][won][np.arange(len(at)), np.array(members)[mixed[won].argmax(axis=1)]]
            part[at] = mixed[won].max(axis=1)
    return choice, part


def mixture(logs: np.ndarray, counts: np.ndarray, share: np.ndarray, floor: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(proportions, log-likelihood, the most it can become) of each text, by expectation-maximisation from ``share``.

    A text is done when what is left to gain is within TOLERANCE, or when it can't pass its floor. With g
    the sums of a language's likelihoods over the mixture's, no proportions reach more than the
    log-likelihood + n * log(max(g) / n).
    """
    share, value, most = share.copy(), np.full(len(counts), -np.inf), np.full(len(counts), np.inf)
    rows = np.arange(len(counts))
    top = logs.max(axis=1, keepdims=True)
    like, base = np.exp(logs - top), np.add.reduceat(top[:, 0], offsets(counts)[:-1])
    live = base > floor
    most[~live] = base[~live]
    for _ in range(ROUNDS):
        if not live.all():
            like, counts, base, rows = like[np.repeat(live, counts)], counts[live], base[live], rows[live]
        if not len(rows):
            break
        at = offsets(counts)[:-1]
        whole = np.maximum(np.einsum("ij,ij->i", like, np.repeat(share[rows], counts, axis=0)), 1e-300)
        value[rows] = base + np.add.reduceat(np.log(whole), at)
        g = np.add.reduceat(like / whole[:, None], at, axis=0) / counts[:, None]
        left = counts * np.log(np.maximum(g.max(axis=1), 1.0))
        most[rows] = np.minimum(most[rows], value[rows] + left)
        live = (left > TOLERANCE) & (most[rows] > floor[rows])
        share[rows[live]] *= g[live]
    return share, value, most


def train(docs: DataFrame, lang_col: str = "lang", text_col: str = "text", bits: int = BITS) -> Languages:
    """The languages of the labelled documents. What reaches the driver is one table of 2**bits counters for each language."""
    table = counts_by_language(docs, lang_col, text_col, bits).toPandas()
    counts = {}
    for lang, part in table.groupby("lang"):
        counts[lang] = np.zeros(1 << bits)
        counts[lang][part.gram.to_numpy()] = part.n.to_numpy()
    return Languages(counts, bits)


def predict(docs: DataFrame, languages: Languages, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, lang_pred, score): "und" and 0 for null texts, texts without a letter, or when no language was learned."""
    names = languages.names
    keep: dict = {}

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        model = keep.setdefault("model", languages)
        data, edges = text_bytes(batch.column(1))
        lettered = np.asarray(batch.column(2).fill_null(False))
        picks, scores = [], []
        for a, b in row_blocks(edges, SPAN):
            best, score = model.infer(data[edges[a] : edges[b]], edges[a : b + 1] - edges[a])
            picks.append(best)
            scores.append(score)
        best, score = np.concatenate(picks), np.concatenate(scores)
        fine = lettered & (best >= 0)
        pred = [names[i] if ok else "und" for i, ok in zip(best.tolist(), fine.tolist(), strict=True)]
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(pred, pa.string()), pa.array(np.where(fine, score, 0.0))], names=["doc_id", "lang_pred", "score"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("t"), F.col(text_col).rlike(r"\p{L}").alias("lettered"))
    return map_arrow(rows, run, "doc_id long, lang_pred string, score double")


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    held = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(4)) == 2
    languages = train(docs.filter(F.coalesce(~held, F.lit(False))))
    out = predict(docs, languages)
    return out.select("doc_id", F.coalesce(held, F.lit(False)).alias("held_out"), "lang_pred", "score")
