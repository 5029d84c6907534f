import random
import re

import pytest

from ledgerlake.llm.jaccard_join import link


def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def brute(rows):
    sets = {i: shingles(t) for i, t in rows}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for x, i in enumerate(ids):
        for j in ids[x + 1 :]:
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 80 * len(sets[i] | sets[j]):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return {i: (len(sets[i]), find(i)) for i in ids}


def made(seed, n):
    r = random.Random(seed)
    words = [f"w{k}" for k in range(60)] + ["É", "ß", "a b"]
    prose = lambda k: [r.choice(words) for _ in range(k)]
    line, rows = prose(14), []
    for i in range(n):
        kind = i % 6
        old = re.split(r"\s+", rows[r.randrange(i)][1] or "") if i > 5 else []
        if kind in (0, 1) or not old:
            w = prose(r.choice([0, 1, 3, 5, 6, 8, 12, 30, 70, 150, 400]))
        elif kind == 2:
            w = old[:]
        elif kind == 3:
            w = old[:]
            for _ in range(r.randint(1, 1 + len(w) // 40)):
                w[r.randrange(len(w))] = r.choice(words)
        elif kind == 4:
            w = old + prose(r.randint(0, max(1, len(old) // 4)))
        else:
            w = prose(r.randint(0, 12)) + line + prose(r.randint(0, 12))
        text = "".join(x.upper() + r.choice([" ", "\n", "\t ", " "]) if r.random() < 0.1 else x + " " for x in w)
        rows.append((i * 7 + 3, text))
    # a chain of near copies, each a small step from the one before
    base = prose(80)
    for k in range(60):
        base = base[:]
        base[(k * 5) % 80] = f"step{k}"
        rows.append((100_000 + k, " ".join(base)))
    # near copies of one text, each changed in a place of its own
    base = prose(100)
    for k in range(80):
        w = base[:]
        w[k] = f"own{k}"
        rows.append((200_000 - k, " ".join(w)))
    r.shuffle(rows)
    return rows


@pytest.mark.parametrize(("seed", "small", "block"), [(1, 64, 2000), (2, 3, 4), (3, 8, 50), (4, 16, 300)])
def test_against_all_pairs(spark, seed, small, block):
    rows = made(seed, 500)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in link(df, small=small, block=block).collect()}
    assert got == brute(rows)


def test_edges(spark):
    t = "a b c d e f g h"
    rows = [(5, None), (6, ""), (7, " \n"), (8, "x"), (9, "X "), (2, t), (2, t), (4, t.upper()), (1, "other words here"), (None, t)]
    df = spark.createDataFrame([(i, x, "k", 1) for i, x in rows], "doc_id long, text string, key string, n int")
    got = sorted(((r.doc_id or 0), r.n_shingles, r.component_id) for r in link(df).collect())
    assert [x for x in got if x[0] in (5, 6, 7)] == [(5, 0, 5), (6, 0, 6), (7, 0, 7)]
    assert [x for x in got if x[0] in (8, 9)] == [(8, 1, 8), (9, 1, 8)]
    assert [x for x in got if x[0] in (0, 2, 4)] == [(0, 4, None), (2, 4, None), (2, 4, None), (4, 4, None)]
    assert link(df.limit(0)).count() == 0
