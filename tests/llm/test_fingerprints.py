import hashlib
import random

from ledgerlake.llm.fingerprints import _common, compare_edits, fingerprint, likeness


def lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(row[j] + 1 if x == y else max(row[j + 1], new[j]))
        row = new
    return row[-1]


def test_common_subsequences():
    r = random.Random(1)
    a = ["".join(r.choices("ABCD+/9", k=r.randint(0, 64))) for _ in range(300)]
    b = ["".join(r.choices("ABCD+/9", k=r.randint(0, 64))) for _ in range(300)]
    assert _common(a, b).tolist() == [lcs(x, y) for x, y in zip(a, b)]


def test_whole_table(spark):
    r = random.Random(2)
    words = ["".join(r.choices("abcdefgé", k=5)) for _ in range(2000)]
    rows = [(i, " ".join(r.choices(words, k=r.choice([0, 1, 40, 400, 3000])))) for i in r.sample(range(-500, 5000), 200)]
    rows += [(7000, None), (7000, "tie"), (None, "last"), (6000, rows[3][1])]
    df = spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id long, text string, n_chars int").repartition(3)
    got = compare_edits(df).collect()
    assert len(got) == len(rows)
    by_id = {x.doc_id: x for x in got if x.doc_id != 7000}
    order = sorted((x for x in rows if x[0] not in (None, 7000)), key=lambda x: -x[0]) + [(None, "last")]
    for (i, t), (_, nxt) in zip(order, order[1:]):
        half = len(t) // 2
        edited = t[: len(t) - half] + nxt[:half]
        assert by_id[i].n_chars == len(t) and by_id[i].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        if len(t) > 2000:
            assert by_id[i].near_edited >= 0.3
    assert by_id[6000].fingerprint == by_id[rows[3][0]].fingerprint
    marks = {x.doc_id: x.fingerprint for x in fingerprint(df).collect()}
    assert all(marks[i] == x.fingerprint for i, x in by_id.items())
    long = [x for x in got if x.n_chars > 10_000]
    assert sum(x.near_next for x in long) < 0.2 * len(long)
    assert likeness([by_id[6000].fingerprint], [by_id[6000].fingerprint])[0] == 1.0


def test_edges(spark):
    df = spark.createDataFrame([(4, "only one text here")], "doc_id long, text string")
    (row,) = compare_edits(df).collect()
    assert row.near_next == 1.0 and row.n_chars == 18
    assert compare_edits(df.limit(0)).count() == 0
    big = "".join(random.Random(3).choices("abcdefgh ", k=3_000_000))
    df = spark.createDataFrame([(1, big), (2, big[:1000] + "X" + big[1000:]), (3, None)], "doc_id long, text string")
    got = {x.doc_id: x for x in compare_edits(df).collect()}
    assert got[2].near_next > 0.9 and got[3].near_next < 0.5


def test_common_subsequences_of_long_signatures():
    r = random.Random(4)
    a = ["".join(r.choices("AB+9", k=r.randint(0, 300))) for _ in range(60)]
    b = [r.choice([x[: len(x) // 2], x[:70] + "A" + x[70:], "".join(r.choices("AB+9", k=r.randint(0, 300)))]) for x in a]
    assert _common(a, b).tolist() == [lcs(x, y) for x, y in zip(a, b)]


def test_repetitive_texts_are_judged_whole(spark):
    r = random.Random(5)
    prose = lambda n: "".join(r.choices("abcdefgh ", k=n))
    heads = [prose(25) * 80 for _ in range(60)]  # the later half differs altogether
    rows = [(2 * i + j, h + prose(2000)) for i, h in enumerate(heads) for j in (0, 1)]
    got = {x.doc_id: x for x in compare_edits(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    marks = [[got[2 * i + j].fingerprint for i in range(60)] for j in (0, 1)]
    long = lambda m: m.split(":")[0] if len(m.split(":")[1]) > 64 else None
    capped = [i for i in range(60) if long(marks[0][i]) and long(marks[0][i]) == long(marks[1][i])]
    assert len(capped) >= 5
    score = likeness(*marks)
    for i in capped:
        (_, x, _), (_, y, _) = marks[0][i].split(":"), marks[1][i].split(":")
        assert x[:60] == y[:60] and x[-10:] != y[-10:] and score[i] < 0.95
        assert 0.3 <= got[2 * i + 1].near_edited < 0.9  # its successor is its twin
