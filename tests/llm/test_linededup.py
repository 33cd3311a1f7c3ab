"""Line dedup: patience alignment, rare lines, copies, edge cases."""

import random

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from spindle.llm import linededup
from spindle.llm.linededup import common_blocks, patience

A, B, C, D = (f"this is telling line number {c} of the text" for c in "abcd")


def lost(spark, rows, **options):
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("row", F.monotonically_increasing_id())
    return sorted(((r.doc_id, r.n_lines, r.lost) for r in linededup.lost_lines(df, "row", **options).collect()),
                  key=lambda x: (x[0] is None, x[0] or 0, x[1], x[2]))


def test_patience_aligns_equal_items_in_order():
    rng = random.Random(4)
    for _ in range(300):
        a = [rng.randrange(12) for _ in range(rng.randrange(14))]
        b = [x for x in a if rng.random() < 0.7] + [rng.randrange(12) for _ in range(rng.randrange(4))]
        pairs = patience(a, b)
        assert all(a[i] == b[j] for i, j in pairs)
        assert all(p[0] < q[0] and p[1] < q[1] for p, q in zip(pairs, pairs[1:], strict=False))
    assert patience([1, 2, 3, 9, 4], [7, 1, 2, 3, 4, 8]) == [(0, 1), (1, 2), (2, 3), (4, 4)]
    assert patience([], [1]) == [] and patience([1], []) == []


def test_gaps_without_unique_lines_get_a_longest_common_subsequence(monkeypatch):
    assert common_blocks([8, 1, 1, 9], [7, 1, 6], [0, 1, 1, 0]) in ([1], [2])
    assert len(patience([8, 1, 1, 9], [7, 1, 6, 1, 5])) == 2

    def longest(a, b):
        row = [0] * (len(b) + 1)
        for x in a:
            row, above = [0], row
            for j, y in enumerate(b):
                row.append(above[j] + 1 if x == y else max(above[j + 1], row[j]))
        return row[-1]
    rng = random.Random(8)
    for n in range(400):
        monkeypatch.setattr(linededup, "TABLE_BITS", 20 if n % 2 else 1 << 28)
        a, b = ([rng.randrange(5) for _ in range(rng.randrange(16))] for _ in "ab")
        pairs = sorted(linededup.common_subsequence(a, b, 0, len(a), 0, len(b)))
        assert all(a[i] == b[j] for i, j in pairs) and len(pairs) == longest(a, b)
        assert all(p[0] < q[0] and p[1] < q[1] for p, q in zip(pairs, pairs[1:], strict=False))


def test_repeated_passages_are_found(spark):
    rows = [(1, f"first\n{A}\nend of first"), (2, f"second\n{A}\n{A}\nend of second"), (3, f"third\n{A}\nmiddle of third\n{A}\nend of third")]
    assert [len(x[2]) for x in lost(spark, rows)] == [0, 1, 1]


def test_blocks_need_a_telling_line():
    assert common_blocks([5, 1, 6], [5, 1, 7], [False, True, True]) == [0, 1]
    assert common_blocks([5, 1, 6], [5, 2, 7], [False, True, True]) == []


def test_later_documents_lose_common_blocks(spark):
    rows = [(1, f"{A}\n{B}\n{C}"), (2, f"own first line of the second\n{A}\n{B}\nshort"), (3, "nothing in common with the others\nshort")]
    assert lost(spark, rows) == [(1, 3, []), (2, 4, [1, 2]), (3, 2, [])]


def test_frequent_lines_need_company(spark):
    rows = [(i, f"{A}\ndocument {i} has a body of its own") for i in range(6)]
    assert all(x[2] == [] for x in lost(spark, rows, rare=3))
    assert sum(x[2] == [0] for x in lost(spark, rows, rare=6)) == 5
    rows = [(i, f"{A}\n{B}\ndocument {i} has a body of its own") for i in range(6)]
    assert sum(x[2] == [0, 1] for x in lost(spark, rows, rare=3)) == 5


def test_very_frequent_lines_are_lost_without_company(spark):
    passage = " ".join(f"word{i}" for i in range(60))
    rows = [(i, f"{passage}\ndocument {i} has a body of its own") for i in range(150)]
    assert [x[2] for x in lost(spark, rows)] == [[]] + [[0]] * 149


def test_copies_of_a_block_meet_wherever_its_lines_came_first(spark):
    rows = [(1, f"{A}\n{B}"), (2, f"second\n{B}\n{A}"), (3, f"third\n{B}\n{A}")]
    assert [x[2] for x in lost(spark, rows)][2] == [1, 2]
    rows = [(1, f"one\n{A}"), (2, f"two\n{B}"), (3, f"three\n{A}\nshort\n{B}"), (4, f"four\n{A}\nshort\n{B}")]
    assert [x[2] for x in lost(spark, rows)] == [[], [], [1, 3], [1, 2, 3]]


def test_hashes_of_runs():
    rng = random.Random(5)
    lines = np.array([rng.randrange(-2 ** 63, 2 ** 63) for _ in range(9)])
    lines = np.concatenate([lines, lines, lines[:4]])
    starts, ends = (np.array(x) for x in zip(*((a, b) for a in range(22) for b in range(a + 1, 23)), strict=True))
    keys = [tuple(lines[a:b]) for a, b in zip(starts, ends, strict=True)]
    hashes = linededup.run_hashes(lines, starts, ends).tolist()
    assert len(set(zip(keys, hashes, strict=True))) == len(set(keys)) == len(set(hashes))
    assert all(len(k) > 1 or h == k[0] for k, h in zip(keys, hashes, strict=True))


def test_passages_of_short_lines_are_found(spark):
    verse = "\n".join(f"verse {i}" for i in range(30))
    rows = [(1, f"{verse}\nfirst"), (2, f"second\n{verse}\nlast"), (3, f"third\nverse 7\nverse 8"), (4, verse), (5, verse), (6, verse[:20]), (7, verse[:20])]
    assert [x[2] for x in lost(spark, rows)] == [[], [*range(1, 31)], [], [*range(30)], [*range(30)], [], []]


def test_seeds_are_the_shared_runs():
    rng = random.Random(6)
    for _ in range(200):
        chars = np.array([rng.randrange(7) for _ in range(rng.randrange(1, 14))])
        lines = np.array([rng.randrange(2 ** 62) for _ in chars])
        n = len(chars)
        enough = {(a, b) for a in range(n) for b in range(a + 1, n + 1) if sum(chars[a:b]) >= 9}
        least = {(a, b) for a, b in enough if not {(a + 1, b), (a, b - 1)} & enough}
        assert set(zip(*(x.tolist() for x in linededup.least_runs(chars, 9)), strict=True)) == least
        hashed = lambda runs: sorted(int(linededup.run_hashes(lines, np.array([a]), np.array([b]))[0]) for a, b in runs)
        common = {r for r in least if rng.random() < 0.7}
        inside = lambda a, b: {r for r in least if a <= r[0] and r[1] <= b}
        longer = {(a, a + w) for w in (2, 4, 8) for a in range(n - w + 1) if inside(a, a + w) and inside(a, a + w) <= common}
        assert linededup.least_seeds(lines, chars, 9).tolist() == hashed(least)
        assert linededup.longer_seeds(lines, chars, np.array(hashed(common), np.int64), 9).tolist() == hashed(longer)


def test_edge_cases(spark):
    rows = [(5, None), (4, None), (6, ""), (None, f"{A}\n{B}"), (7, f"{A}\n{B}"), (7, f"{A}\n{B}"), (8, "tiny"), (9, "tiny"),
            (10, "\n".join(f"line {i} of the very long document" for i in range(4000)))]
    assert lost(spark, rows) == [(4, 1, []), (5, 1, []), (6, 1, []), (7, 2, []), (7, 2, [0, 1]), (8, 1, []), (9, 1, []),
                                 (10, 4000, []), (None, 2, [0, 1])]
    assert lost(spark, []) == []


def test_texts_without_the_lost_lines(spark):
    rows = [(1, f"{A}\n{B}", "en", 7), (2, f"{A}\nown line, kept in the text\n{B}", "de", 8), (3, f"{A}\n{B}", "en", 9), (4, None, None, None),
            (5, "", "en", 0)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lost string, n_chars long")
    got = {r.doc_id: tuple(r)[1:] for r in linededup.drop_lost_lines(df).collect()}
    kept = "own line, kept in the text"
    assert got == {1: (f"{A}\n{B}", "en", 7), 2: (kept, "de", len(kept)), 4: (None, None, None), 5: ("", "en", 0)}
    assert linededup.drop_lost_lines(df).columns == df.columns


def test_every_telling_line_survives_somewhere(spark):
    from conftest import SF
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    telling = lambda df: {x for r in df.select("text").collect() for x in (r.text or "").split("\n") if len(x) >= linededup.MIN_CHARS}
    after = linededup.drop_lost_lines(docs)
    assert telling(after) == telling(docs)
    assert after.count() < docs.count()


def test_lines_of_one_hash_and_different_text_do_not_align():
    row = {"later": 7, "later_lines": [5, 6, 7], "later_checks": [1, 2, 3], "earlier_lines": [5, 6, 7], "earlier_checks": [1, 9, 3],
           "later_chars": [30, 30, 30]}
    got = linededup._align(iter([pa.RecordBatch.from_pylist([row])]), 24)
    assert next(got).to_pylist() == [{"later": 7, "lost": [0, 2]}]


def brute(rows, least):
    """The lost lines by text alone: every shared run and its earliest holder, pairs aligned."""
    order = sorted(range(len(rows)), key=lambda n: (rows[n][0] is None, rows[n][0] or 0, n))
    first = {}
    for n in order:
        first.setdefault(rows[n][1] or "", n)
    lines = {n: t.split("\n") for t, n in first.items()}
    enough = lambda run: sum(map(len, run)) >= least
    holders, runs = {}, {}
    for n in first.values():
        t = lines[n]
        runs[n] = [(a, b) for a in range(len(t)) for b in range(a + 1, len(t) + 1)
                   if enough(t[a:b]) and not enough(t[a + 1:b]) and not enough(t[a:b - 1])]
        for a, b in runs[n]:
            holders.setdefault(tuple(t[a:b]), []).append(n)
    shared = {k for k, v in holders.items() if len(set(v)) > 1}
    for n in first.values():
        t, width = lines[n], 2
        while width <= len(t):
            for a in range(len(t) - width + 1):
                inside = [tuple(t[x:y]) for x, y in runs[n] if a <= x and y <= a + width]
                if inside and all(k in shared for k in inside):
                    holders.setdefault(tuple(t[a:a + width]), []).append(n)
            width *= 2
    place = {n: p for p, n in enumerate(order)}
    pairs = {(n, min(v, key=place.get)) for v in holders.values() for n in v}
    gone = {n: set() for n in range(len(rows))}
    for later, earlier in pairs:
        if later != earlier:
            gone[later].update(common_blocks(lines[later], lines[earlier], [len(x) for x in lines[later]], least))
    for n, (_, text) in enumerate(rows):
        t = (text or "").split("\n")
        if first[text or ""] != n and enough(t):
            gone[n] = set(range(len(t)))
    return sorted(((rows[n][0], len((rows[n][1] or "").split("\n")), sorted(x)) for n, x in gone.items()),
                  key=lambda x: (x[0] is None, x[0] or 0, x[1], x[2]))


def test_losses_equal_brute_force(spark):
    rng = random.Random(9)
    stock = [f"line {i} " + "x" * rng.choice([0, 3, 20, 40]) for i in range(30)]
    passages = [[rng.choice(stock) for _ in range(rng.randrange(1, 7))] for _ in range(12)]
    rows = []
    for i in range(120):
        text = []
        for _ in range(rng.randrange(1, 5)):
            text += rng.choice(passages) if rng.random() < 0.6 else [f"own line {rng.randrange(400)}"] * rng.randrange(1, 3)
        rows.append((rng.choice([None, i, i // 2]), rng.choice([None, "", "\n".join(text), "\n".join(text), "\n".join(text)])))
    rows += rng.sample(rows, 15)
    got = lost(spark, rows)
    assert got == brute(rows, linededup.MIN_CHARS)
    assert sum(bool(x[2]) for x in got) > 40
