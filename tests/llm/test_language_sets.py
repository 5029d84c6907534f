"""The choice among language sets against plain expectation-maximisation over every set."""

from itertools import combinations

import numpy as np
import pytest

from ledgerlake.llm.language_id import PENALTY, best_sets, mixture


def plain(logs, penalty=PENALTY):
    """(value, set, proportions) of the best set, by 3,000 rounds for each."""
    best = None
    for size in range(1, logs.shape[1] + 1):
        for members in combinations(range(logs.shape[1]), size):
            own = logs[:, members]
            share = np.full(size, 1 / size)
            like = np.exp(own - own.max(axis=1, keepdims=True))
            for _ in range(3_000 if size > 1 else 1):
                share = (like * share / (like @ share)[:, None]).mean(axis=0)
            value = (np.log(like @ share) + own.max(axis=1)).sum() - size * penalty
            if best is None or value > best[0]:
                best = value, members, share
    return best


def texts(seed, k):
    """Words of up to three languages, some of which are nearly alike."""
    r = np.random.default_rng(seed)
    out = []
    for _ in range(12):
        n = int(r.integers(1, 60))
        own = r.choice(k, size=min(k, int(r.integers(1, 4))), replace=False)
        logs = -20 + r.normal(0, 3, (n, k))
        logs[np.arange(n), r.choice(own, n)] += r.uniform(1, 8)
        if k > 2:
            logs[:, 1] = logs[:, 0] + r.normal(0, 0.3, n)
        out.append(logs)
    return out


@pytest.mark.parametrize("k", [1, 2, 4])
def test_best_of_all_sets(k):
    several = 0
    for seed in range(2):
        parts = texts(seed, k)
        choice, part = best_sets(np.vstack(parts), np.array([len(x) for x in parts]))
        for logs, c, p in zip(parts, choice, part, strict=True):
            _, members, share = plain(logs)
            several += len(members) > 1
            if len(share) == 1 or np.ptp(np.sort(share)[-2:]) > 0.02:
                assert c == members[share.argmax()]
            assert abs(p - share.max()) < 0.02
    assert several > 3 or k == 1


def test_bound_holds():
    parts = texts(9, 4)
    logs, counts = np.vstack(parts), np.array([len(x) for x in parts])
    start = np.full((len(parts), 4), 0.25)
    share, value, most = mixture(logs, counts, start, np.full(len(parts), -np.inf))
    assert np.allclose(share.sum(axis=1), 1) and (most >= value).all() and (most - value < 2e-3).all()
    best = [plain(x, 0.0)[0] for x in parts]
    assert (np.array(best) <= most + 1e-9).all() and np.allclose(best, value, atol=2e-3)
    # a floor no mixture reaches ends the work, and says so
    assert (mixture(logs, counts, start, most + 5)[2] <= most + 5).all()


def test_texts_of_more_languages_than_are_combined():
    parts = texts(4, 6)
    logs, counts = np.vstack(parts), np.array([len(x) for x in parts])
    whole, some = best_sets(logs, counts, among=6), best_sets(logs, counts, among=4)
    assert (whole[0] == some[0]).mean() > 0.9
