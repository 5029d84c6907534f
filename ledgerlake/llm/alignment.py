"""Alignment of the tokens of two tokenizers, with a fast path for tokens of the same bytes.

Texts are cut where both tokenizers always end a token; what stands between two cuts is encoded by
both, aligned once and kept. Byte offsets where a token of either ends cut a text into
segments; each lies in one token of A and one of B, which is a link. Where both end, a group ends.

An id of A maps to the id of B with the same bytes, if there is one. Links to it are counted in one
vector with an entry for each id of A; only the links of the other (irregular) groups are counted
as pairs in a shuffle. For the documents' sums, the counts of frequent pairs (held by at least one in
``RARE`` documents; a bounded number) go to every task, so no document shuffles a hot pair;
the other pairs of a document are joined with their counts.
"""

from __future__ import annotations

import hashlib
import json
import os
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.llm.byte_bpe import lone_line_ends, lone_spaces
from ledgerlake.llm.common import Words, documents, held, letter_sign_cuts, merged_cuts, offsets, ragged_index, row_blocks, stored, text_bytes, trimmed

RARE = 1000
FREQUENT = 1 << 19  # pairs that a task holds at most (9 MB)
KNOWN = 400_000  # aligned chunks that a worker keeps
BLOCK = 1 << 20  # bytes aligned at once
PIECE_SPACE = "▁"


class Growing:
    """An array that items are added to."""

    def __init__(self, dtype, width: int = 0):
        self.data, self.used = np.zeros((1024, width) if width else 1024, dtype), 0

    def add(self, items: np.ndarray) -> None:
        need = self.used + len(items)
        if need > len(self.data):
            self.data = np.concatenate([self.data, np.zeros((need, *self.data.shape[1:]), self.data.dtype)])
        self.data[self.used : need] = items
        self.used = need


class ByteLevel:
    """A byte-level BPE file of the ``tokenizers`` library; special tokens' strings are ordinary text."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.lib = Tokenizer.from_file(path)
        self.lib.encode_special_tokens = True
        with open(path, encoding="utf-8") as f:
            vocab = json.load(f)["model"]["vocab"]
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        other = [b for b in range(256) if b not in plain]
        byte = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(other)}
        self.bytes = [b""] * (max(vocab.values()) + 1)
        for piece, k in vocab.items():
            if all(c in byte for c in piece):
                self.bytes[k] = bytes(byte[c] for c in piece)

    def encode(self, keys: list[bytes]) -> list[list[int]]:
        texts = [k.decode("utf-8", "replace") for k in keys]
        return [e.ids for e in self.lib.encode_batch(texts, add_special_tokens=False)]


class Pieces:
    """A BPE model of ``sentencepiece`` that adds a space in front and writes spaces as U+2581."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        self.lib = SentencePieceProcessor(model_file=path)
        self.bytes, merged = [], []
        for k in range(self.lib.vocab_size()):
            piece = self.lib.id_to_piece(k)
            if self.lib.is_byte(k):
                self.bytes.append(bytes([int(piece[3:5], 16)]))
            elif self.lib.is_control(k) or self.lib.is_unknown(k) or self.lib.is_unused(k):
                self.bytes.append(b"")
            else:
                self.bytes.append(piece.replace(PIECE_SPACE, " ").encode())
                merged.append(self.bytes[-1])
        #: byte pairs that stand together in some piece: between all others a token ends
        self.inside = np.zeros((256, 256), bool)
        for text in merged:
            b = np.frombuffer(text, np.uint8)
            self.inside[b[:-1], b[1:]] = True
        if self.inside[10].any() or self.inside[:, 10].any():
            raise ValueError("a piece holds a line end; chunks without a leading space need another guard")

    def encode(self, keys: list[bytes]) -> list[list[int]]:
        """Ids of chunks from the middle of a text; a space in front is the one that the model adds.

        Other chunks stand behind a line end, which joins no piece; the two ids of it and of the added space go.
        """
        lead = [k[:1] == b" " for k in keys]
        texts = [k[1:].decode("utf-8", "replace") if x else "\n" + k.decode("utf-8", "replace") for k, x in zip(keys, lead, strict=True)]
        return [ids if x else ids[2:] for ids, x in zip(self.lib.encode(texts, num_threads=1), lead, strict=True)]


def _ids(lists: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    lens = np.fromiter(map(len, lists), np.int64, len(lists))
    return np.fromiter(chain.from_iterable(lists), np.int64, int(lens.sum())), lens


class Chunks(Words):
    """Chunks known by their hash, with their text form of groups, links and sizes."""

    def __init__(self, aligner: Aligner):
        self.aligner = aligner
        super().__init__(self._align, KNOWN)

    def reset(self) -> None:
        super().reset()
        self.links, self.sizes, self.first = Growing(np.int64), Growing(np.int64, 5), Growing(np.int64)

    def _align(self, keys: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        forms, lens, links, sizes = self.aligner.align(keys)
        self.first.add(self.links.used + np.cumsum(sizes[:, 3]) - sizes[:, 3])
        self.links.add(links)
        self.sizes.add(sizes)
        return forms, lens


class Aligner:
    def __init__(self, path_a: str, path_b: str):
        self.a, self.b = ByteLevel(path_a), Pieces(path_b)
        self.size_a = np.array([len(x) for x in self.a.bytes], np.int64)
        self.size_b = np.array([len(x) for x in self.b.bytes], np.int64)
        self.n_b = len(self.b.bytes)
        by: dict[bytes, int] = {}
        for k, x in sorted(enumerate(self.b.bytes), key=lambda p: (self.b.lib.is_byte(p[0]), p[0])):
            by.setdefault(x, k)
        #: the id of B with the same bytes, or -1
        self.same = np.array([by.get(x, -1) if x else -1 for x in self.a.bytes], np.int64)
        digits = [str(k).encode() for k in range(max(len(self.a.bytes), self.n_b))]
        self.digit_len = np.array([len(d) for d in digits], np.int64)
        self.digits, self.digit_at = np.frombuffer(b"".join(digits), np.uint8), offsets(self.digit_len)[:-1]
        self.flat_a, self.at_a = np.frombuffer(b"".join(self.a.bytes), np.uint8), offsets(self.size_a)[:-1]
        self.flat_b, self.at_b = np.frombuffer(b"".join(self.b.bytes), np.uint8), offsets(self.size_b)[:-1]
        self.chunks = Chunks(self)

    def cuts(self, data: np.ndarray) -> np.ndarray:
        """Positions where a token of either tokenizer ends whatever stands around."""
        at = merged_cuts(lone_spaces(data), lone_line_ends(data), letter_sign_cuts(data))
        return at[~self.b.inside[data[at - 1], data[at]]]

    @staticmethod
    def _joined(flat, at, size, ids, lens, data, edges) -> np.ndarray:
        """Which rows' tokens join to the bytes of their chunk."""
        whole = np.diff(offsets(size[ids])[offsets(lens)])
        fine = whole == np.diff(edges)
        use = np.repeat(fine, lens)
        joined = flat[ragged_index(at[ids[use]], size[ids[use]])]
        want = data[ragged_index(edges[:-1][fine], np.diff(edges)[fine])]
        bad = np.concatenate([[0], np.cumsum(joined != want)])
        ends = offsets(whole[fine])
        fine[np.flatnonzero(fine)[bad[ends[1:]] > bad[ends[:-1]]]] = False
        return fine

    def align(self, keys: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """For chunks: the text form of their groups (each ends in ';'), its lengths, the links a * n_b + b, and rows (tokens of A, of B, groups, links, joins)."""
        data, edges = np.frombuffer(b"".join(keys), np.uint8), offsets(np.array([len(k) for k in keys], np.int64))
        a, la = _ids(self.a.encode(keys))
        b, lb = _ids(self.b.encode(keys))
        fine = self._joined(self.flat_a, self.at_a, self.size_a, a, la, data, edges) & self._joined(self.flat_b, self.at_b, self.size_b, b, lb, data, edges)
        a, b = a[np.repeat(fine, la)], b[np.repeat(fine, lb)]
        la, lb, long = la * fine, lb * fine, np.diff(edges) * fine
        end_a, end_b, ends = np.cumsum(self.size_a[a]), np.cumsum(self.size_b[b]), np.cumsum(long)
        every = np.union1d(end_a, end_b)
        both = np.intersect1d(end_a, end_b, assume_unique=True)
        who_a, who_b = np.searchsorted(end_a, every), np.searchsorted(end_b, every)
        links = a[who_a] * self.n_b + b[who_b]
        count = lambda x: np.diff(np.concatenate([[0], np.searchsorted(x, ends, side="right")]))
        sizes = np.stack([la, lb, count(both), count(every), fine], axis=1).astype(np.int64)
        # ids of a group: those of A, then those of B, each with the sign behind it
        group = np.concatenate([2 * np.searchsorted(both, end_a), 2 * np.searchsorted(both, end_b) + 1])
        order = np.argsort(group, kind="stable")
        group, ids = group[order], np.concatenate([a, b])[order]
        last = np.append(group[1:] != group[:-1], True) if len(group) else np.zeros(0, bool)
        sign = np.where(last, np.where(group % 2, ord(";"), ord("|")), ord(",")).astype(np.uint8)
        width = self.digit_len[ids] + 1
        forms = np.zeros(int(width.sum()), np.uint8)
        ends_at = np.cumsum(width) - 1
        is_sign = np.zeros(len(forms), bool)
        is_sign[ends_at] = True
        forms[ends_at] = sign
        forms[~is_sign] = self.digits[ragged_index(self.digit_at[ids], self.digit_len[ids])]
        group_bytes = np.diff(offsets(width)[offsets(la + lb)])
        return forms, group_bytes, links, sizes

    def texts(self, data: np.ndarray, edges: np.ndarray):
        """(numbers of the chunks, how many each text has, whether it is aligned) of a space and each text."""
        size = np.diff(edges)
        spaced = np.insert(data, edges[:-1], 32)
        at = edges[:-1] + np.arange(len(size))
        starts = merged_cuts(self.cuts(spaced), at)
        ends = np.append(starts[1:], len(spaced))
        numbers = self.chunks.number(spaced, starts, ends)
        counts = np.diff(np.append(np.searchsorted(starts, at), len(starts)))
        whole = np.minimum.reduceat(self.chunks.sizes.data[numbers, 4], offsets(counts)[:-1]) > 0 if len(counts) else np.zeros(0, bool)
        return numbers, counts, whole & (size > 0)

    def links(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        lens = self.chunks.sizes.data[numbers, 3]
        return self.chunks.links.data[ragged_index(self.chunks.first.data[numbers], lens)], lens

    def held_links(self, numbers: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(text, link, times) for each distinct link of each text, in this order."""
        doc = np.repeat(np.arange(len(counts)), counts)
        some, times = np.unique(doc * len(self.chunks.lens) + numbers, return_counts=True)
        doc, number = some // len(self.chunks.lens), some % len(self.chunks.lens)
        link, lens = self.links(number)
        doc, times = np.repeat(doc, lens), np.repeat(times, lens)
        order = np.lexsort((link, doc))
        doc, link, times = doc[order], link[order], times[order]
        heads = np.flatnonzero(np.concatenate([[True], (doc[1:] != doc[:-1]) | (link[1:] != link[:-1])])) if len(doc) else np.zeros(0, np.int64)
        return doc[heads], link[heads], np.add.reduceat(times, heads) if len(heads) else times


def aligner(path_a: str, path_b: str) -> Aligner:
    return held(f"aligner {path_a} {path_b}", lambda: Aligner(path_a, path_b))


def _blocks(batch: pa.RecordBatch, column: int, al: Aligner):
    """(first row, chunk numbers, counts, aligned) of blocks of rows with a text."""
    data, edges = text_bytes(batch.column(column))
    for a, b in row_blocks(edges, BLOCK):
        yield a, b, *al.texts(data[edges[a] : edges[b]], edges[a : b + 1] - edges[a])


def _merged(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    code, back = np.unique(np.concatenate([p for p, _ in parts]), return_inverse=True)
    return code, np.bincount(back, weights=np.concatenate([n for _, n in parts]), minlength=len(code)).astype(np.int64)


def counted(rows: DataFrame, path_a: str, path_b: str) -> tuple[DataFrame, DataFrame]:
    """How many texts (column ``t``) hold a link: (a, docs) to the id with the same bytes, (code, docs) for other pairs."""
    name = f"aligner {path_a} {path_b}"

    def run(batches):
        al = aligner(path_a, path_b)
        regular = np.zeros(len(al.same), np.int64)
        parts, size = [], 0
        out = lambda same, code, docs: pa.RecordBatch.from_arrays([pa.array(np.full(len(code), same)), pa.array(code), pa.array(docs)], names=["same", "code", "docs"])
        for batch in batches:
            for _, _, numbers, counts, fine in _blocks(batch, 0, al):
                doc, link, _ = al.held_links(numbers, counts)
                link = link[fine[doc]]
                a = link // al.n_b
                usual = al.same[a] == link % al.n_b
                regular += np.bincount(a[usual], minlength=len(regular))
                parts.append(np.unique(link[~usual], return_counts=True))
                size += len(parts[-1][0])
                if size > 1 << 20:  # the partition's counts so far
                    parts = [_merged(parts)]
                    size = len(parts[0][0])
                    if size > 1 << 19:
                        yield out(False, *parts[0])
                        parts, size = [], 0
        if parts:
            yield out(False, *_merged(parts))
        a = np.flatnonzero(regular)
        yield out(True, a, regular[a])

    both = stored(rows.select("t").mapInArrow(trimmed(run, name), "same boolean, code long, docs long"), "links")
    regular = both.filter("same").groupBy(F.col("code").alias("a")).agg(F.sum("docs").alias("docs"))
    pairs = both.filter("not same").groupBy("code").agg(F.sum("docs").alias("docs"))
    return regular, pairs


def _frequent(pairs: DataFrame, n_docs: int) -> DataFrame:
    """Pairs that at least one in RARE documents holds, or as much more frequent ones as FREQUENT allows."""
    step = F.floor(F.log2("docs") * 16)
    sizes = sorted(pairs.filter(F.col("docs") * RARE >= n_docs).groupBy(step.alias("step")).count().collect(), key=lambda r: -r["step"])
    total, low = 0, None
    for r in sizes:  # about a thousand steps at most
        total += r["count"]
        if total > FREQUENT:
            break
        low = r["step"]
    return pairs.filter((F.col("docs") * RARE >= n_docs) & (step >= low) if low is not None else F.lit(False))


def align(docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) of every text.

    Of the groups' text form only the hash is given (texts may be long); without tokens it is ''.
    Null and empty texts, and texts whose tokens do not join to a space and the text, have no
    tokens. Rows are documents: a row that repeats another counts again and comes out again; null ids
    stay null, an empty table gives an empty result, other columns are ignored. A link is best
    if as many documents hold its pair as any pair of its A id (ties are all best).
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("t"))
    regular, pairs = counted(rows, path_a, path_b)
    n_b = len(Pieces(path_b).bytes)
    pairs = stored(pairs, "pairs")
    top = pairs.groupBy(F.floor(F.col("code") / n_b).alias("a")).agg(F.max("docs").alias("docs"))
    same = {r["a"]: r["docs"] for r in regular.collect()}  # both of at most one row for each id of A
    best = {r["a"]: r["docs"] for r in top.collect()}
    n_docs = rows.count()
    hot = _frequent(pairs, n_docs).toArrow().sort_by("code")
    size = 1 + max([*same, *best, 0])
    regular_docs, best_docs = np.zeros(size, np.int64), np.zeros(size, np.int64)
    for table, counts in ((regular_docs, same), (best_docs, same), (best_docs, best)):
        k = np.fromiter(counts, np.int64, len(counts))
        np.maximum.at(table, k, np.fromiter(counts.values(), np.int64, len(counts)))
    shared = spark.sparkContext.broadcast((hot["code"].to_numpy(), hot["docs"].to_numpy(), regular_docs, best_docs))
    name = f"aligner {path_a} {path_b}"
    schema = "row long, doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string, codes array<long>, times array<int>"

    def block(al: Aligner, ids: pa.Array, keys: pa.Array, numbers, counts, fine) -> pa.RecordBatch:
        code, docs_of, regular_of, best_of = shared.value
        n, edges = len(counts), offsets(counts)
        total = np.zeros((n, 4), np.int64)
        for k in range(4):
            total[:, k] = np.diff(offsets(al.chunks.sizes.data[numbers, k])[edges]) * fine
        forms, lens = al.chunks.values(numbers)
        at = offsets(lens)[edges]
        hashes = [hashlib.sha256(forms[s : e - 1].tobytes()).hexdigest() if f else "" for s, e, f in zip(at[:-1].tolist(), at[1:].tolist(), fine.tolist(), strict=True)]
        doc, link, times = al.held_links(numbers, counts)
        use = fine[doc]
        doc, link, times = doc[use], link[use], times[use]
        a = link // al.n_b
        usual = al.same[a] == link % al.n_b
        spot = np.minimum(np.searchsorted(code, link), max(len(code) - 1, 0))
        known = ~usual & (code[spot] == link) if len(code) else np.zeros(len(link), bool)
        held_by = np.zeros(len(link), np.int64)
        held_by[usual] = regular_of[a[usual]]
        held_by[known] = docs_of[spot[known]]
        there = usual | known
        is_best = there & (held_by == best_of[np.minimum(a, len(best_of) - 1)])
        summed = np.zeros((2, n), np.int64)
        np.add.at(summed[0], doc[is_best], times[is_best])
        np.add.at(summed[1], doc[there], (times * held_by)[there])
        rest = np.bincount(doc[~there], minlength=n)
        lists = lambda x, kind: pa.ListArray.from_arrays(pa.array(offsets(rest).astype(np.int32)), pa.array(x[~there].astype(kind)))
        columns = [keys, ids, *(pa.array(total[:, k]) for k in range(4)), pa.array(summed[0]), pa.array(summed[1]), pa.array(hashes), lists(link, np.int64), lists(times, np.int32)]
        return pa.RecordBatch.from_arrays(columns, names=["row", "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256", "codes", "times"])

    def run(batches):
        al = aligner(path_a, path_b)
        for batch in batches:
            for a, b, numbers, counts, fine in _blocks(batch, 2, al):
                yield block(al, batch.column(1).slice(a, b - a), batch.column(0).slice(a, b - a), numbers, counts, fine)

    keyed = rows.select(F.monotonically_increasing_id().alias("row"), "doc_id", "t")
    made = stored(keyed.mapInArrow(trimmed(run, name), schema), "aligned")  # row numbers hold from here on
    rare = made.select("row", F.explode(F.arrays_zip("codes", "times")).alias("x")).select("row", F.col("x.codes").alias("code"), F.col("x.times").alias("times"))
    tops = spark.createDataFrame(pa.table({"a": np.arange(size), "most": best_docs}))
    judged = pairs.withColumn("a", F.floor(F.col("code") / n_b)).join(F.broadcast(tops), "a").select("code", "docs", (F.col("docs") == F.col("most")).alias("top"))
    sums = rare.join(judged, "code").groupBy("row").agg(F.sum(F.when(F.col("top"), F.col("times")).otherwise(0)).alias("more_best"), F.sum(F.col("times") * F.col("docs")).alias("more_sum"))
    out = made.drop("codes", "times").join(sums, "row", "left")
    return out.select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links",
        (F.col("n_best") + F.coalesce("more_best", F.lit(0))).alias("n_best"),
        (F.col("count_sum") + F.coalesce("more_sum", F.lit(0))).alias("count_sum"),
        "groups_sha256",
    )


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return align(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))
