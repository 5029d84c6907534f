"""Mixture-controlled packing by deficit round-robin.

Every source is a queue of tokenized documents. Time runs in windows of a fixed number of tokens;
in each window a queue is credited its share of the window, serves chunks while its credit covers
them and carries the rest of the credit (its deficit) on. A queue's chunk is at most its
share of a window, so that every window holds every source up to a chunk. The served chunks form one gapless
stream that is cut every ``window`` tokens, so only the very last window of all can be short.

For a cluster, time is cut into buckets of about a million tokens. What a queue has been served by
the begin of a bucket follows from the weights alone (all queues served in parallel until they run
dry), so a bucket takes from every queue exactly its stretch, documents cut where stretches end: it
begins with deficits below one token and no queue of it runs dry before its time. Where a document
lies in its queue is a running sum, taken in two levels over cells (a hash of the document), so a
hot source is spread over all cells.
"""

from __future__ import annotations

from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ledgerlake.llm.common import SPAN, Words, binary_column, documents, held, letter_sign_cuts, map_arrow, offsets, row_blocks, stored, text_bytes, word_ranges

WINDOW = 4096
CHUNK, LEAST = 512, 32  # most and fewest tokens of a chunk
IDLE = 1e-9  # weight of sources that are to be served when all others have run dry
LATIN_END = "ɐ"  # below it lie the Latin letters with one form each
BUCKET_TOKENS = 1 << 20
CELLS = 8  # cells of documents for each bucket
BLOCK = 4096  # cells or buckets whose sums are run over in one group
PIECES = "doc_id long, source string, start long, length long, doc_tokens long, sequence_id long, offset long, ids binary"


LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


class WordTokenizer:
    """Ids of whole texts by a word-ended BPE file of the ``tokenizers`` library, words encoded once.

    The file drops white space and never merges across it, so a text's ids are those of its words.
    Words of plain Latin letters, digits and signs are lower-cased, split and handed to the file's
    model directly; all others go through the file's whole chain. Special tokens' strings in a text
    are ordinary text.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        self.whole.encode_special_tokens = True
        # fixed value: the split pattern of the tokenizer file
        self.split = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\s\p{L}\p{N}]+").findall
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        other = [b for b in range(256) if b not in plain]
        self.letters = {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(other)}
        self.words = Words(self._words)

    def _words(self, keys: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        out = []
        model, letters = self.whole.model.tokenize, self.letters
        for word in [k.decode("utf-8", "replace") for k in keys]:
            if word.isascii() and word.isalpha():
                out.append([t.id for t in model(word)])
                continue
            if max(word) < LATIN_END:
                word = word.lower()
                if max(word) < LATIN_END:
                    parts = [word] if word.isalpha() else self.split(word)
                    out.append([t.id for p in parts for t in model(p.encode().decode("latin-1").translate(letters))])
                    continue
            out.append(self.whole.encode(word, add_special_tokens=False).ids)
        lens = np.fromiter(map(len, out), np.int64, len(out))
        return np.fromiter(chain.from_iterable(out), np.int32, int(lens.sum())), lens

    def encode(self, data: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids one after the other, how many each text has) of the texts between the edges."""
        data = LOWER[data]
        starts, ends, counts = word_ranges(data, edges, more=letter_sign_cuts(data))
        ids, lens = self.words.values(self.words.number(data, starts, ends))
        return ids, np.diff(offsets(lens)[offsets(counts)])


def tokenizer(path: str) -> WordTokenizer:
    return held(f"words of {path}", lambda: WordTokenizer(path))


def tokenize(docs: DataFrame, path: str, end_id: int, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """(doc_id, source, n, tokens): every text's ids and ``end_id``, as little-endian 16-bit or, for ids beyond, 32-bit integers."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        tok, (data, edges) = tokenizer(path), text_bytes(batch.column(2))
        wide = "<u2" if max(tok.whole.get_vocab_size(), end_id) < 1 << 16 else "<u4"
        values, sizes = [], []
        for a, b in row_blocks(edges, SPAN):
            ids, lens = tok.encode(data[edges[a] : edges[b]], edges[a : b + 1] - edges[a])
            ends = np.cumsum(lens)
            values.append(np.insert(ids, ends, end_id).astype(wide))
            sizes.append(lens + 1)
        n = np.concatenate(sizes)
        return pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(n), binary_column(np.concatenate(values), offsets(n))], names=["doc_id", "source", "n", "tokens"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(source_col).cast("string").alias("source"), F.col(text_col).alias("t"))
    return map_arrow(rows, run, "doc_id long, source string, n long, tokens binary", keep=f"words of {path}")


class Fluid:
    """Where each queue stands if all are served in parallel at their weights until they run dry."""

    def __init__(self, totals: dict, weights: dict):
        self.knots: dict = {s: ([0.0], [0.0]) for s in totals}
        done, now, live = dict.fromkeys(totals, 0.0), 0.0, {s for s, t in totals.items() if t}
        while live:
            total = sum(weights[s] for s in live)
            step = min((totals[s] - done[s]) * total / weights[s] for s in live)
            now += step
            for s in list(live):
                done[s] += step * weights[s] / total
                self.knots[s][0].append(now)
                self.knots[s][1].append(done[s])
                if done[s] >= totals[s] * (1 - 1e-12):
                    live.discard(s)

    def at(self, source, time: float) -> float:
        return float(np.interp(time, *self.knots[source]))


def chunks(weights: list[float], window: int, most: int = CHUNK, least: int = LEAST) -> list[int]:
    """Tokens in a chunk of each queue: its share of a window, within the bounds."""
    total = sum(weights) or 1.0
    return [int(min(most, max(least, w / total * window))) for w in weights]


def serve(queues: list[list[int]], weights: list[float], deficits: list[float], start: int, window: int, chunk: list[int]):
    """Deficit round-robin over the queues (lists of document sizes): yields (queue, document, first token, tokens)."""
    heads, done = [0] * len(queues), [0] * len(queues)
    credit = list(deficits)
    live = [s for s in range(len(queues)) if queues[s]]
    room = window - start % window
    while live:
        total = sum(weights[s] for s in live)
        for s in live:
            credit[s] += room * weights[s] / total
            sizes = queues[s]
            while heads[s] < len(sizes):
                n = min(chunk[s], sizes[heads[s]] - done[s])
                if n > credit[s] + 1e-6:
                    break
                yield s, heads[s], done[s], n
                credit[s] -= n
                done[s] += n
                if done[s] == sizes[heads[s]]:
                    heads[s], done[s] = heads[s] + 1, 0
        live = [s for s in live if heads[s] < len(queues[s])]
        room = window


def pack(tokens: DataFrame, window: int = WINDOW, chunk: int = CHUNK, least: int = LEAST, bucket_tokens: int = BUCKET_TOKENS, weights: dict[str, float] | None = None) -> DataFrame:
    """Pieces of all documents in sequences of ``window`` tokens (columns of PIECES).

    ``tokens`` has the columns of tokenize(). The target proportions are ``weights`` by source (those
    not named weigh as their tokens do; the named ones in proportion to all tokens), by default the
    proportions of the corpus, so that all queues last to the end. Nothing is dropped: when a queue
    runs dry the others share its credit; a source of weight zero or less is served when the others are
    dry. A chunk holds a source's share of a window, ``least`` to ``chunk`` tokens: shares below ``least``
    are served in every so many windows, their deficit carried on. A null source is a queue like any other; repeated rows
    and ids stay; an empty table gives an empty result.
    """
    item = lambda n, t: "<u2" if len(t) == 2 * n else "<u4"
    queue = F.coalesce(F.concat(F.lit("="), "source"), F.lit(""))
    u = F.xxhash64("doc_id", "n", F.crc32("tokens"))
    tokens = tokens.withColumn("q", queue)
    totals = stored(tokens.groupBy("q", "source").agg(F.sum("n").alias("whole")), "pack-totals")
    whole = totals.agg(F.sum("whole")).first()[0] or 0
    n_buckets = max(1, -(-whole // bucket_tokens))
    weights = {s: max(w, IDLE) for s, w in weights.items()} if weights else {}
    # as many sources as the caller names
    named = {r["source"]: r["whole"] for r in totals.filter(F.col("source").isin(list(weights))).collect()} if weights else {}
    rest = float(whole - sum(named.values()))
    total = {s: float(named.get(s, 0)) for s in weights} | {None: rest}
    fluid = Fluid(total, {s: w * whole for s, w in weights.items()} | {None: max(rest, 1e-9)})

    def served(source: pd.Series, whole_of: pd.Series, bucket: np.ndarray) -> np.ndarray:
        """Tokens of each source that are served before the bucket."""
        out = np.zeros(len(source), np.int64)
        key = source.where(source.isin(list(weights)), None)
        size = whole_of.to_numpy()
        for s in [*weights, None]:
            mine = (key.isna() if s is None else key == s).to_numpy()
            part = np.interp(bucket[mine] * float(bucket_tokens), *fluid.knots[s]) / max(total[s], 1.0)
            out[mine] = np.floor(part * size[mine])
        return np.where(bucket >= n_buckets, size, np.minimum(out, size))

    if weights:

        @F.pandas_udf("long")
        def begins(source: pd.Series, whole_of: pd.Series, bucket: pd.Series) -> pd.Series:
            return pd.Series(served(source, whole_of, bucket.to_numpy()))

        @F.pandas_udf("long")
        def bucket_of(source: pd.Series, whole_of: pd.Series, pos: pd.Series) -> pd.Series:
            at = pos.to_numpy()
            lo, hi = np.zeros(len(at), np.int64), np.full(len(at), n_buckets, np.int64)
            while (hi - lo > 1).any():  # the last bucket that begins at or before the place
                mid = (lo + hi) // 2
                before = served(source, whole_of, mid) <= at
                lo, hi = np.where(before, mid, lo), np.where(before, hi, np.maximum(mid, lo + 1))
            return pd.Series(lo)
    else:  # in proportion to all tokens, in whole numbers

        def begins(source, whole_of, bucket):
            whole_of, bucket, n = F.col(whole_of), F.col(bucket) if isinstance(bucket, str) else bucket, F.lit(n_buckets).cast("long")
            each = ((whole_of - whole_of % n) / n).cast("long")
            return each * bucket + F.floor((whole_of % n) * bucket / n)

        def bucket_of(source, whole_of, pos):
            guess = F.floor(pos / F.col(whole_of) * n_buckets).cast("long")
            fit = lambda d: begins(source, whole_of, guess + d) <= pos
            return F.greatest(F.lit(0), F.when(fit(1), guess + 1).when(fit(0), guess).otherwise(guess - 1))

    w = W.partitionBy("q")
    cells = tokens.withColumn("cell", F.pmod(u, F.lit(n_buckets * CELLS))).groupBy("q", "cell").agg(F.sum("n").alias("sum"))
    cells = stored(cells.withColumn("block", F.floor(F.col("cell") / BLOCK)), "pack-cells")
    sums = cells.groupBy("q", "block").agg(F.sum("sum").alias("bsum"))
    sums = sums.select("q", "block", (F.sum("bsum").over(w.orderBy("block")) - F.col("bsum")).alias("before"), F.sum("bsum").over(w).alias("whole"))
    inside = F.sum("sum").over(W.partitionBy("q", "block").orderBy("cell")) - F.col("sum")
    cells = cells.withColumn("inside", inside).join(sums, ["q", "block"]).select("cell", "q", "whole", (F.col("before") + F.col("inside")).alias("before"))

    in_cell = W.partitionBy("cell", "q").orderBy("doc_id", "n", "mark").rowsBetween(W.unboundedPreceding, 0)
    rows = tokens.withColumn("cell", F.pmod(u, F.lit(n_buckets * CELLS))).withColumn("mark", F.crc32("tokens"))
    rows = rows.withColumn("pos", F.sum("n").over(in_cell) - F.col("n")).join(cells, ["cell", "q"])
    rows = rows.select("doc_id", "source", "q", "tokens", "whole", F.col("n").alias("size"), (F.col("pos") + F.col("before")).alias("pos"))
    rows = rows.withColumn("b0", bucket_of("source", "whole", F.col("pos"))).withColumn("b1", bucket_of("source", "whole", F.col("pos") + F.col("size") - 1))
    rows = rows.withColumn("bucket", F.explode(F.sequence("b0", "b1")))
    rows = rows.withColumn("served", begins("source", "whole", "bucket")).withColumn("next", begins("source", "whole", F.col("bucket") + 1))
    rows = rows.withColumn("first", F.greatest(F.lit(0), F.col("served") - F.col("pos"))).withColumn("n", F.least(F.col("size"), F.col("next") - F.col("pos")) - F.col("first"))
    wide = (F.octet_length("tokens") / F.col("size")).cast("int")
    part = F.substring("tokens", (F.col("first") * wide + 1).cast("int"), (F.col("n") * wide).cast("int"))
    pos = F.col("pos") + F.col("first")
    rows = rows.filter("n > 0").select("bucket", "doc_id", "source", "q", "whole", "served", "size", pos.alias("pos"), "first", "n", part.alias("tokens"))
    # where the stream of a bucket begins: what all queues were served by then
    blocks = totals.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit((n_buckets - 1) // BLOCK))))
    bucket = F.explode(F.sequence(F.col("block").cast("long") * BLOCK, F.least(F.lit(n_buckets - 1).cast("long"), F.col("block").cast("long") * BLOCK + BLOCK - 1)))
    state = blocks.withColumn("bucket", bucket).withColumn("at", begins("source", "whole", "bucket")).groupBy("bucket").agg(F.sum("at").alias("begin"))

    def run(docs: pd.DataFrame, state: pd.DataFrame) -> pd.DataFrame:
        if docs.empty:
            return pd.DataFrame(columns=names)
        docs = docs.sort_values(["q", "pos"], kind="stable")
        queues = docs.drop_duplicates("q")
        begin = int(state.begin.iloc[0])
        known = [s if s in weights else None for s in queues.source]
        own = docs.groupby("q", sort=True).indices
        rows = [own[k] for k in queues.q]
        share = np.array([weights[k] * whole if k is not None else float(w) for k, w in zip(known, queues.whole, strict=True)])
        # the begins of queues are whole numbers: what they cut off is the deficit that is carried in
        time = float(docs.bucket.iloc[0]) * bucket_tokens if weights else float(docs.bucket.iloc[0]) * whole / n_buckets
        due = np.array([fluid.at(k, time) * (w / max(total[k], 1.0)) for k, w in zip(known, queues.whole, strict=True)])
        number, first_of, whole_doc = docs.n.to_numpy(), docs["first"].to_numpy(), docs["size"].to_numpy()
        at, out = begin, []
        for s, k, first, n in serve([number[r].tolist() for r in rows], share.tolist(), (due - queues.served.to_numpy()).tolist(), begin, window, chunks(share.tolist(), window, chunk, least)):
            r = rows[s][k]
            while n:
                take = min(n, window - at % window)
                if out and out[-1][0] == r and out[-1][1] + out[-1][2] == first and at % window:
                    out[-1][2] += take
                else:
                    out.append([r, first, take, at])
                at, first, n = at + take, first + take, n - take
        r, first, n, at = np.array(out, np.int64).T
        ids = [np.frombuffer(t, item(m, t)).astype("<u4") for t, m in zip(docs.tokens, number, strict=True)]
        return pd.DataFrame({
            "doc_id": docs.doc_id.to_numpy()[r], "source": docs.source.to_numpy()[r], "start": first_of[r] + first, "length": n, "doc_tokens": whole_doc[r],
            "sequence_id": at // window, "offset": at % window, "ids": [ids[i][a : a + m].tobytes() for i, a, m in zip(r, first, n, strict=True)],
        })

    names = [x.split()[0] for x in PIECES.split(", ")]
    return rows.groupBy("bucket").cogroup(state.groupBy("bucket")).applyInPandas(run, PIECES)


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    tokens = stored(tokenize(documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"), 2), "pack-tokens")
    return pack(tokens).select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset", "source")
