"""Conditional random field and network against enumeration and numeric gradients."""

from itertools import product

import numpy as np

from ledgerlake.llm import quality
from ledgerlake.llm.crf import Crf


def _score(crf, e, path):
    return crf.first[path[0]] + sum(e[t, y] for t, y in enumerate(path)) + sum(crf.moves[a, b] for a, b in zip(path, path[1:]))


def test_viterbi_against_all_paths():
    r = np.random.default_rng(1)
    for _ in range(20):
        k = int(r.integers(1, 5))
        crf = Crf([str(i) for i in range(k)])
        crf.moves, crf.first = r.normal(0, 2, (k, k)), r.normal(0, 2, k)
        lens = r.permutation(np.array([0, 1, 1, 2, 3, 5, 5]))
        e = r.normal(0, 2, (int(lens.sum()), k))
        got, at = crf.decode(e, lens), 0
        for n in lens.tolist():
            if n:
                best = max(product(range(k), repeat=n), key=lambda p: _score(crf, e[at : at + n], p))  # noqa: B023
                assert tuple(got[at : at + n]) == best
            at += n
    assert len(Crf(["a"]).decode(np.zeros((0, 1)), np.zeros(0, np.int64))) == 0


def test_training_reaches_the_optimum():
    """Where training ends, the penalised likelihood over all enumerated paths is flat in every weight."""
    r = np.random.default_rng(2)
    labels, names = ["x", "y", "z"], ["f", "g", "h"]
    table = [[(list(r.choice(names, int(r.integers(1, 3)), replace=False)), labels[int(r.integers(3))]) for _ in range(n)] for n in (1, 2, 3, 4, 4, 2)]
    decay = 0.5
    crf = Crf(labels).fit(table, rounds=4000, rate=0.003, decay=decay)

    def value():
        total = 0.0
        for seq in table:
            e = np.array([crf.weights[crf.numbers(f)].sum(axis=0) for f, _ in seq])
            every = [_score(crf, e, p) for p in product(range(3), repeat=len(seq))]
            total += _score(crf, e, [labels.index(y) for _, y in seq]) - np.log(np.exp(every).sum())
        return total - 0.5 * decay * len(table) / 10 * sum((x**2).sum() for x in (crf.weights, crf.moves, crf.first))

    for x in (crf.weights, crf.moves, crf.first):
        for at in np.ndindex(x.shape):
            old = x[at]
            x[at] = old + 1e-4
            up = value()
            x[at] = old - 1e-4
            down = value()
            x[at] = old
            assert abs(up - down) / 2e-4 < 0.02


def test_network_gradients():
    r = np.random.default_rng(3)
    net = quality.Network(5)
    for name in ("embed", "filters", "bias", "top", "base"):  # numeric differences need more than single precision
        setattr(net, name, getattr(net, name).astype(np.float64))
    net.bias += 0.05
    texts = [bytes(r.integers(97, 123, int(n)).astype(np.uint8)) for n in (0, 5, 127, 128, 400, 700)]
    labels = np.array([1.0, 0, 1, 0, 1, 0])

    def loss():
        total = 0.0
        for t, y in zip(texts, labels, strict=True):
            p = net.scores(np.frombuffer(t, np.uint8), np.array([0, len(t)]))[0]
            total -= y * np.log(p) + (1 - y) * np.log(1 - p)
        return total / len(texts)

    # training lays texts side by side: give each batch one text, whose windows see zeros after its end
    grads = [sum(g) / len(texts) for g in zip(*[net._gradients([t], labels[i : i + 1], r) for i, t in enumerate(texts)])]
    for p, g in zip(net.params(), grads, strict=True):
        for at in {tuple(int(r.integers(n)) for n in p.shape) for _ in range(12)} | {np.unravel_index(int(np.abs(g).argmax()), p.shape)}:
            old = p[at]
            p[at] = old + 1e-6
            up = loss()
            p[at] = old - 1e-6
            down = loss()
            p[at] = old
            assert abs((up - down) / 2e-6 - g[at]) < 1e-4 + 0.01 * abs(g[at]), (p.shape, at)
