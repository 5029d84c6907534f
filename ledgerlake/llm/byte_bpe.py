"""Byte-level BPE by prefix dynamic programming.

For every byte prefix of a piece there is exactly one token that can end its encoding. A token t
that ends at position j is that one if, and only if, the token stored for the prefix before it and
t can stand side by side: no merge across their border would come before the merges that build
them. So one array of last tokens per piece holds the encodings of all its prefixes: bytes appended
later leave it as it is, and after an edit only a stretch beside the edit is computed anew.
"""

from __future__ import annotations

import base64
from functools import cached_property, lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.llm.common import LETTERS, SPAN, Words, binary_column, blocks, documents, letter_sign_cuts, map_arrow, merged_cuts, offsets, ragged_index, row_blocks, text_bytes

def _mixed(keys: np.ndarray) -> np.ndarray:
    return keys.astype(np.uint64) * BASE


BASE = np.uint64(0x9E3779B97F4A7C15)
NEVER = np.int64(1) << 40
LONG_PIECE = 128  # bytes from which a piece is encoded by itself instead of in a matrix of pieces


class Slots:
    """A read-only map from 64-bit keys to numbers: one slot by hash, the few that clash in a sorted list."""

    def __init__(self, keys: np.ndarray, values: np.ndarray, bits: int):
        self.shift = np.uint64(64 - bits)
        slot = keys >> self.shift
        self.key, self.value = np.zeros(1 << bits, np.uint64), np.full(1 << bits, -1, np.int64)
        self.key[slot], self.value[slot] = keys, values
        rest = self.value[slot] != values
        order = np.argsort(keys[rest])
        self.more, self.more_value = keys[rest][order], values[rest][order]
        self.shared = np.zeros(1 << bits, bool)
        self.shared[slot[rest]] = True

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The numbers of the keys, -1 where there is none."""
        slot = keys >> self.shift
        out = np.where(self.key[slot] == keys, self.value[slot], -1)
        if len(self.more):
            again = np.flatnonzero(self.shared[slot] & (out < 0))
            at = np.minimum(np.searchsorted(self.more, keys[again]), len(self.more) - 1)
            same = self.more[at] == keys[again]
            out[again[same]] = self.more_value[at[same]]
        return out


class Merges:
    """Tables derived from the ranks: how tokens are built, which neighbours merge, token hashes."""

    def __init__(self, path: str):
        with open(path, "rb") as lines:
            self.rank = {base64.b64decode(a): int(b) for a, b in (x.split() for x in lines if x.strip())}
        self.longest = max(map(len, self.rank))
        n = max(self.rank.values()) + 1
        self.bytes = [b""] * n
        for text, k in self.rank.items():
            self.bytes[k] = text
        self.size = np.array([len(x) for x in self.bytes], np.int64)
        # when a token comes to be: bytes at the start, others by their rank
        self.born = np.where(self.size <= 1, -1, np.arange(n)).astype(np.int64)
        self.left, self.right = np.arange(n), np.arange(n)
        self.real = np.zeros(n, bool)
        for text, k in self.rank.items():
            parts = self._merge(text, k)
            if len(text) == 1:
                self.real[k] = True
            elif len(parts) == 2:
                self.left[k], self.right[k] = (self.rank[x] for x in parts)
                self.real[k] = True
        pairs = {}
        for text, k in self.rank.items():
            for i in range(1, len(text)):
                a, b = self.rank.get(text[:i]), self.rank.get(text[i:])
                if a is not None and b is not None:
                    pairs[a << 20 | b] = k
        self.pair = pairs

    def _merge(self, text: bytes, below: int) -> list[bytes]:
        """The parts left by the merges of rank under ``below``, in order of rank."""
        parts = [text[i : i + 1] for i in range(len(text))]
        get = self.rank.get
        while len(parts) > 1:
            best = min((get(parts[i] + parts[i + 1], below), i) for i in range(len(parts) - 1))
            if best[0] >= below:
                break
            i = best[1]
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
        return parts

    @cached_property
    def pair_slots(self) -> Slots:
        keys = np.fromiter(self.pair, np.int64, len(self.pair))
        return Slots(_mixed(keys), np.fromiter(self.pair.values(), np.int64, len(keys)), 20)

    @cached_property
    def token_slots(self) -> Slots:
        ids = np.flatnonzero(self.real)
        h = np.zeros(len(ids), np.uint64)
        for x, k in enumerate(ids.tolist()):
            v = 0
            for c in self.bytes[k]:
                v = (v * int(BASE) + c + 1) & 0xFFFFFFFFFFFFFFFF
            h[x] = v
        return Slots(h, ids, 20)

    @cached_property
    def judged(self) -> tuple[np.ndarray, np.ndarray]:
        """Pairs looked at lately and whether they can stand side by side, one for each slot."""
        return np.zeros(1 << 20, np.int64), np.zeros(1 << 20, bool)

    def merged(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The rank by which tokens a and b merge, or NEVER."""
        rank = self.pair_slots.find(_mixed(a << 20 | b))
        return np.where(rank < 0, NEVER, rank)

    def fits(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """side_by_side() with a memory of recent pairs."""
        known, verdict = self.judged
        key = (a << 20 | b) + 1
        slot = (_mixed(key) >> np.uint64(44)).astype(np.int64)
        new = np.flatnonzero(known[slot] != key)
        if len(new):
            fine = self.side_by_side(a[new], b[new])
            out = verdict[slot]
            out[new] = fine
            known[slot[new]], verdict[slot[new]] = key[new], fine
            return out
        return verdict[slot]

    def side_by_side(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether BPE leaves tokens a and b as they are when a comes right before b.

        Runs time backwards: the younger of the two border tokens is taken apart, the other waits;
        at each state a merge across the border must not come before the merge that ends the state
        (of equal merges the left one goes first).
        """
        good = np.ones(len(a), bool)
        live = np.arange(len(a))
        a, b = a.copy(), b.copy()
        until_a, until_b = np.full(len(a), NEVER), np.full(len(a), NEVER)
        while len(live):
            cross = self.merged(a, b)
            bad = (cross < until_a) & (cross <= until_b)
            good[live[bad]] = False
            born_a, born_b = self.born[a], self.born[b]
            go = ~bad & ((born_a >= 0) | (born_b >= 0))
            live, a, b, until_a, until_b, born_a, born_b = (x[go] for x in (live, a, b, until_a, until_b, born_a, born_b))
            first = born_a > born_b
            until_a, until_b = np.where(first, born_a, until_a), np.where(first, until_b, born_b)
            a, b = np.where(first, self.right[a], a), np.where(first, b, self.left[b])
        return good

    @lru_cache(maxsize=200_000)  # noqa: B019  one object per worker
    def neighbours(self, a: int, b: int) -> bool:
        until_a = until_b = int(NEVER)
        born, pair = self.born, self.pair
        while True:
            cross = pair.get(a << 20 | b, int(NEVER))
            if cross < until_a and cross <= until_b:
                return False
            x, y = int(born[a]), int(born[b])
            if x < 0 and y < 0:
                return True
            if x > y:
                a, until_a = int(self.right[a]), x
            else:
                b, until_b = int(self.left[b]), y


class Prefixes:
    """The stored last tokens of one piece; grows by ``append`` and mends by ``edit``."""

    def __init__(self, merges: Merges, data: bytes = b""):
        self.m, self.data, self.last = merges, b"", []
        self.append(data)

    def _token(self, j: int) -> int:
        """The unique last token of the prefix of length j (those of shorter prefixes are known)."""
        m, data = self.m, self.data
        for n in range(min(m.longest, j), 0, -1):
            k = m.rank.get(data[j - n : j])
            if k is not None and m.real[k] and (n == j or m.neighbours(self.last[j - n - 1], k)):
                return k
        raise ValueError("a byte has no token")

    def append(self, more: bytes) -> None:
        start = len(self.data)
        self.data += more
        for j in range(start + 1, len(self.data) + 1):
            self.last.append(self._token(j))

    def edit(self, start: int, end: int, new: bytes) -> int:
        """Replace bytes [start, end) by ``new``; returns how many last tokens were computed anew.

        From the first place where ``longest`` tokens in a row equal the old ones, all later ones do.
        """
        tail, shift = self.last[start:], len(new) - (end - start)
        self.data = self.data[:start] + new + self.data[end:]
        self.last = self.last[:start]
        same = count = 0
        for j in range(start + 1, len(self.data) + 1):
            self.last.append(self._token(j))
            count += 1
            old = j - shift - start - 1
            beyond = j - self.m.longest > start + len(new)
            same = same + 1 if beyond and old >= 0 and tail[old] == self.last[-1] else 0
            if same >= self.m.longest:
                self.last += tail[old + 1 :]
                break
        return count

    def tokens(self) -> list[int]:
        out, j = [], len(self.data)
        while j:
            out.append(self.last[j - 1])
            j -= int(self.m.size[out[-1]])
        return out[::-1]


def encode_pieces(m: Merges, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(ids one after the other, how many each piece has); pieces of like length go through one matrix."""
    whole = np.fromiter((m.rank.get(p, -1) for p in pieces), np.int64, len(pieces))
    size = np.fromiter(map(len, pieces), np.int64, len(pieces))
    lens = (whole >= 0).astype(np.int64)
    parts = [(np.flatnonzero(whole >= 0), whole[whole >= 0])]
    for i in np.flatnonzero((whole < 0) & (size >= LONG_PIECE)).tolist():
        ids = np.array(Prefixes(m, pieces[i]).tokens(), np.int64)
        lens[i] = len(ids)
        parts.append((np.array([i]), ids))
    todo = np.flatnonzero((whole < 0) & (size > 0) & (size < LONG_PIECE))
    todo = todo[np.argsort(-size[todo], kind="stable")]  # the longest first
    for x in range(0, len(todo), 20_000):
        part = todo[x : x + 20_000]
        ids, lens[part] = _encode_matrix(m, [pieces[i] for i in part.tolist()])
        parts.append((part, ids))
    starts = np.cumsum(lens) - lens
    flat = np.zeros(int(lens.sum()), np.int64)
    for who, ids in parts:
        flat[ragged_index(starts[who], lens[who])] = ids
    return flat, lens


def _encode_matrix(m: Merges, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Prefix dynamic programming over all pieces at once, position by position; longest piece first."""
    n, sizes = len(pieces), np.array([len(p) for p in pieces])
    width = int(sizes[0])
    chars = np.frombuffer(b"".join(p.ljust(width, b"\0") for p in pieces), np.uint8).reshape(n, width).T.astype(np.uint64) + np.uint64(1)
    slots = m.token_slots
    last = np.zeros((width + 1, n), np.int32)
    with np.errstate(over="ignore"):
        powers = np.cumprod(np.concatenate([[np.uint64(1)], np.full(m.longest, BASE, np.uint64)]))
        for j in range(1, width + 1):
            rows = int(np.searchsorted(-sizes, -j, side="right"))
            h = np.zeros(rows, np.uint64)
            found = []
            for size in range(1, min(j, m.longest) + 1):
                h = h + chars[j - size, :rows] * powers[size - 1]
                token = slots.find(h)
                hit = np.flatnonzero(token >= 0)
                found.append((size, hit, token[hit]))
            open_ = np.ones(rows, bool)
            for size, who, token in reversed(found):
                left = open_[who]
                who, token = who[left], token[left]
                if size < j and len(who):
                    fine = m.fits(last[j - size, who].astype(np.int64), token)
                    who, token = who[fine], token[fine]
                last[j, who] = token
                open_[who] = False
    steps, at, who, lens = [], sizes.copy(), np.arange(n), np.zeros(n, np.int64)
    while len(who):
        token = last[at[who], who]
        steps.append((who, token))
        lens[who] += 1
        at[who] -= m.size[token]
        who = who[at[who] > 0]
    ends, flat = np.cumsum(lens), np.zeros(int(lens.sum()), np.int64)
    for back, (who, token) in enumerate(steps):
        flat[ends[who] - 1 - back] = token
    return flat, lens


def lone_spaces(data: np.ndarray) -> np.ndarray:
    """Positions of spaces that surely stand between two characters that are not white space.

    The pattern always starts a piece there, so a text can be cut before them. Characters of two
    bytes led by C3 to DF and of three bytes led by E4 to EF are never white space.
    """
    at = np.flatnonzero(data == 32)
    at = at[(at > 2) & (at < len(data) - 1)]
    before, after = data[at - 1], data[at + 1]
    plain = lambda x: (x > 32) & (x < 127)
    two, three = data[at - 2], data[at - 3]
    fine_before = plain(before) | (before >= 128) & (((two >= 0xC3) & (two <= 0xDF)) | ((two >= 128) & (two < 0xC0) & (three >= 0xE4) & (three <= 0xEF)))
    fine_after = plain(after) | ((after >= 0xC3) & (after <= 0xDF)) | ((after >= 0xE4) & (after <= 0xEF))
    return at[fine_before & fine_after]


def lone_line_ends(data: np.ndarray) -> np.ndarray:
    """Positions of ASCII letters behind a line end that stands behind a visible ASCII character."""
    at = np.flatnonzero(data == 10) + 1
    at = at[(at > 1) & (at < len(data))]
    return at[LETTERS[data[at]] & (data[at - 2] > 32) & (data[at - 2] < 127)]


class Encoder:
    """Whole texts to ids. Chunks between single spaces are split by the pattern and encoded once."""

    def __init__(self, path: str, pattern: str):
        self.merges, self.pattern = Merges(path), regex.compile(pattern)
        self.chunks = Words(self._chunks)

    def _chunks(self, keys: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        find, split = self.pattern.findall, []
        for key in keys:
            k = key.decode("utf-8", "replace")
            split.append([k] if k[1:].isalpha() and (k[0] == " " or k[0].isalpha()) else find(k))
        counts = np.fromiter(map(len, split), np.int64, len(split))
        pieces = [p for s in split for p in s]
        known = dict.fromkeys(pieces)
        ids, lens = encode_pieces(self.merges, [p.encode() for p in known])
        for i, p in enumerate(known):
            known[p] = i
        who = np.fromiter(map(known.__getitem__, pieces), np.int64, len(pieces))
        starts = np.cumsum(lens) - lens
        flat = ids[ragged_index(starts[who], lens[who])].astype(np.int32)
        return flat, np.diff(offsets(lens[who])[offsets(counts)])

    def encode(self, data: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids one after the other, how many each text has) of the texts between the edges."""
        starts = merged_cuts(lone_spaces(data), lone_line_ends(data), letter_sign_cuts(data), edges[:-1])
        starts = starts[starts < len(data)]
        ends = np.append(starts[1:], len(data))
        ids, lens = self.chunks.values(self.chunks.number(data, starts, ends))
        return ids, np.diff(offsets(lens)[np.searchsorted(starts, edges)])


@lru_cache(maxsize=2)
def encoder(path: str, pattern: str) -> Encoder:
    return Encoder(path, pattern)


@lru_cache(maxsize=2)
def _vocabulary(path: str) -> tuple[np.ndarray, np.ndarray]:
    with open(path, "rb") as lines:
        pairs = [(int(b), base64.b64decode(a)) for a, b in (x.split() for x in lines if x.strip())]
    table = [b""] * (max(k for k, _ in pairs) + 1)
    for k, text in pairs:
        table[k] = text
    return np.frombuffer(b"".join(table), np.uint8), np.array([len(x) for x in table], np.int64)


def encode(df: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, ids): ids as little-endian unsigned 32-bit integers in one binary value.

    A null or empty text gives an empty value; rows are independent, so repeated ids or texts stay
    repeated, an empty table gives an empty result, and other columns are ignored.
    """

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        enc, (data, edges) = encoder(path, pattern), text_bytes(batch.column(1))
        values, lens = [], []
        for a, b in row_blocks(edges, SPAN):
            ids, n = enc.encode(data[edges[a] : edges[b]], edges[a : b + 1] - edges[a])
            values.append(ids.astype("<u4"))
            lens.append(n)
        return pa.RecordBatch.from_arrays([batch.column(0), binary_column(np.concatenate(values), offsets(np.concatenate(lens)))], names=["doc_id", "ids"])

    return map_arrow(df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("t")), run, "doc_id long, ids binary")


def decode(df: DataFrame, path: str) -> DataFrame:
    """(doc_id, ids) to (doc_id, ids, data): the bytes that the ids stand for. Null ids decode to no bytes."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        flat, size = _vocabulary(path)
        start = np.cumsum(size) - size
        column = [x or b"" for x in batch.column(1).to_pylist()]
        parts = []
        for a, b in blocks([len(x) for x in column], 4 * SPAN):
            ids = np.frombuffer(b"".join(column[a:b]), "<u4").astype(np.int64)
            parts.append((flat[ragged_index(start[ids], size[ids])], np.diff(offsets(size[ids])[offsets(np.array([len(x) // 4 for x in column[a:b]], np.int64))])))
        data = binary_column(np.concatenate([p for p, _ in parts]), offsets(np.concatenate([n for _, n in parts])))
        return pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), data], names=["doc_id", "ids", "data"])

    return map_arrow(df.select("doc_id", "ids"), run, "doc_id long, ids binary, data binary")


def op2_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    out = decode(encode(documents(spark, sf_dir), path, public_tokenizers.PATTERN), path)
    return out.select(
        "doc_id",
        F.floor(F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("data", 256).alias("decoded_sha256"),
    )
