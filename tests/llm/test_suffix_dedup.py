import random

import pytest

from ledgerlake.llm.suffix_dedup import remove_repeats


def brute(rows, window):
    """rows: (doc_id, bytes) with distinct ids; (n_removed, spans, kept) by id."""
    seen, out = set(), {}
    for i, data in sorted(rows):
        covered = bytearray(len(data))
        for s in range(len(data) - window + 1):
            w = data[s : s + window]
            if w in seen:
                covered[s : s + window] = b"\1" * window
            seen.add(w)
        spans = sum(1 for k in range(len(data)) if covered[k] and (k == 0 or not covered[k - 1]))
        out[i] = (sum(covered), spans, bytes(c for c, x in zip(data, covered) if not x))
    return out


def texts(seed, n):
    r = random.Random(seed)
    words = ["".join(r.choices("abcdeéß", k=r.randint(1, 6))) for _ in range(300)]
    prose = lambda k: " ".join(r.choices(words, k=k))
    line, passage = prose(24), prose(60)
    rows = []
    for i in range(n):
        kind = i % 7
        text = prose(r.randint(0, 120))
        if kind == 1:
            text = prose(20) + line + prose(30)
        elif kind == 2:
            text = (line + "\n") * r.randint(1, 6)
        elif kind == 3:
            cut = r.randint(0, 200)
            text = prose(10) + passage[cut : cut + r.randint(90, 200)] + prose(10)
        elif kind == 4 and i > 10:
            old = rows[r.randrange(i)][1] or ""
            at = r.randint(0, len(old))
            text = old[:at] + "X" + old[at + r.randint(0, 3) :]
        elif kind == 5:
            text = "ab" * r.randint(0, 200)
        elif kind == 6 and i > 10:
            text = rows[r.randrange(i)][1]
        rows.append((i * 3 + 1, text))
    r.shuffle(rows)
    return rows


@pytest.mark.parametrize(("hot", "window"), [(64, 100), (2, 100), (2, 40)])
def test_against_all_windows(spark, hot, window):
    rows = texts(hot + window, 300)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = {r.doc_id: (r.n_removed, len(r.spans), bytes(r.kept)) for r in remove_repeats(df, window, 16 if window == 40 else 48, hot).collect()}
    assert got == brute([(i, (t or "").encode()) for i, t in rows], window)


def test_edges(spark):
    long = "".join(random.Random(3).choices("abcd ", k=5_000_000))
    rows = [(1, None), (2, ""), (3, "x" * 99), (4, "x" * 100), (5, "x" * 101), (6, long), (7, long[2_097_000:2_097_300]), (8, "z" + long)]
    df = spark.createDataFrame([(i, t, "k") for i, t in rows], "doc_id long, text string, key string")
    got = {r.doc_id: r for r in remove_repeats(df).collect()}
    assert [got[i].n_removed for i in range(1, 9)] == [0, 0, 0, 0, 101, 0, 300, 5_000_000]
    assert got[8].kept == b"z" and got[5].n_bytes == 101
    assert remove_repeats(df.limit(0)).count() == 0


def test_repeated_and_null_ids(spark):
    t = "".join(random.Random(4).choices("abcdefgh", k=150))
    df = spark.createDataFrame([(None, t), (None, "q" + t), (2, t), (2, t), (3, "short")], "doc_id long, text string")
    got = sorted((r.doc_id or 0, r.n_bytes, r.n_removed) for r in remove_repeats(df).collect())
    assert got[2:] == [(2, 150, 150), (2, 150, 150), (3, 5, 0)]
    assert sorted(x[2] for x in got[:2]) in ([0, 150],)
