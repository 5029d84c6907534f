"""Linear-chain conditional random fields in numpy: training on a small table, Viterbi in batches."""

from __future__ import annotations

import numpy as np

from ledgerlake.llm.common import offsets


def _logsum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return np.log(np.exp(x - top).sum(axis=axis)) + top.squeeze(axis)


class Crf:
    """Weights by (feature, label) and by (label, next label); features are numbered by name, unknown ones count nothing."""

    def __init__(self, labels: list[str]):
        self.labels, self.names = labels, {}
        k = len(labels)
        self.weights, self.moves, self.first = np.zeros((0, k)), np.zeros((k, k)), np.zeros(k)

    def numbers(self, features: list[str]) -> list[int]:
        get = self.names.get
        return [n for n in map(get, features) if n is not None]

    def emissions(self, numbers: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Sums of the weights of each position's features."""
        sums = np.vstack([np.zeros((1, len(self.labels))), np.cumsum(self.weights[numbers], axis=0)])
        edges = offsets(counts)
        return sums[edges[1:]] - sums[edges[:-1]]

    def fit(self, table: list[list[tuple[list[str], str]]], rounds: int = 200, rate: float = 0.1, decay: float = 0.02) -> Crf:
        """Maximum likelihood with a quadratic penalty by Adam; forward-backward over all sequences at once."""
        table = sorted((s for s in table if s), key=len, reverse=True)
        for seq in table:
            for features, _ in seq:
                for f in features:
                    self.names.setdefault(f, len(self.names))
        k, n_seq, width = len(self.labels), len(table), len(table[0])
        place = {y: i for i, y in enumerate(self.labels)}
        lens = np.array([len(s) for s in table])
        inside = np.arange(width)[None, :] < lens[:, None]
        numbers = np.concatenate([self.numbers(f) for s in table for f, _ in s]).astype(np.int64)
        counts = np.array([len(self.numbers(f)) for s in table for f, _ in s])
        gold = np.array([place[y] for s in table for _, y in s])
        hot = np.eye(k)[gold]
        pos = np.repeat(np.arange(len(counts)), counts)
        padded_gold = np.zeros((n_seq, width), np.int64)
        padded_gold[inside] = gold
        theta = [np.zeros((len(self.names), k)), np.zeros((k, k)), np.zeros(k)]
        m, v = [np.zeros_like(x) for x in theta], [np.zeros_like(x) for x in theta]
        for step in range(1, rounds + 1):
            self.weights, self.moves, self.first = theta
            e = np.zeros((n_seq, width, k))
            e[inside] = self.emissions(numbers, counts)
            live = [int((lens > t).sum()) for t in range(width)]
            alpha, beta = np.zeros_like(e), np.zeros_like(e)
            alpha[:, 0] = e[:, 0] + self.first
            for t in range(1, width):
                a = live[t]
                alpha[:a, t] = _logsum(alpha[:a, t - 1, :, None] + self.moves, 1) + e[:a, t]
            for t in range(width - 2, -1, -1):
                a = live[t + 1]
                beta[:a, t] = _logsum(self.moves + (e[:a, t + 1] + beta[:a, t + 1])[:, None, :], 2)
            total = _logsum(alpha[np.arange(n_seq), lens - 1], 1)
            share = np.exp(alpha + beta - total[:, None, None])[inside]
            grads = [np.zeros_like(x) for x in theta]
            np.add.at(grads[0], numbers, (hot - share)[pos])
            for t in range(1, width):
                a = live[t]
                pair = np.exp(alpha[:a, t - 1, :, None] + self.moves + (e[:a, t] + beta[:a, t])[:, None, :] - total[:a, None, None])
                grads[1] -= pair.sum(axis=0)
                np.add.at(grads[1], (padded_gold[:a, t - 1], padded_gold[:a, t]), 1.0)
            head = np.exp(alpha[:, 0] + beta[:, 0] - total[:, None])
            grads[2] += np.bincount(padded_gold[:, 0], minlength=k) - head.sum(axis=0)
            for x, g, p, q in zip(theta, grads, m, v, strict=True):
                g = g - decay * x * n_seq / 10
                p *= 0.9
                p += 0.1 * g
                q *= 0.99
                q += 0.01 * g * g
                x += rate * (p / (1 - 0.9**step)) / (np.sqrt(q / (1 - 0.99**step)) + 1e-8)
        return self

    def decode(self, e: np.ndarray, lens: np.ndarray) -> np.ndarray:
        """The best labels of sequences that lie one after the other, all sequences a step at a time."""
        if not len(e):
            return np.zeros(0, np.int64)
        order = np.argsort(-lens, kind="stable")
        starts, sizes = offsets(lens)[:-1][order], lens[order]
        back = np.zeros(e.shape, np.int8)
        score = e[starts[sizes > 0]] + self.first
        best = np.zeros(len(order), np.int64)
        best[: len(score)] = score.argmax(axis=1)
        for t in range(1, int(sizes[0])):
            a = int(np.searchsorted(-sizes, -t, side="left"))
            ways = score[:a, :, None] + self.moves
            at = starts[:a] + t
            back[at] = ways.argmax(axis=1)
            score[:a] = ways.max(axis=1) + e[at]
            best[:a] = score[:a].argmax(axis=1)
        out = np.zeros(len(e), np.int64)
        for t in range(int(sizes[0]) - 1, -1, -1):
            a = int(np.searchsorted(-sizes, -t, side="left"))
            at = starts[:a] + t
            out[at] = best[:a]
            if t:
                best[:a] = back[at, best[:a]]
        return out
