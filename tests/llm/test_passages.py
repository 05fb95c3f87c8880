"""Relative Lempel-Ziv parsing against brute force: factors, repeated passages and what is left of the texts."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from marketflow.llm import lempel_ziv

WORD = __import__("re").compile(r"[^\x20\x09-\x0D]+")


def brute(rows):
    """(doc_id, n_words, n_removed, kept) of each (doc_id, text), in order."""
    largest = 2**63 - 1
    words = [(d, largest if d is None else d, WORD.findall(t or "")) for d, t in rows]
    first = {}
    for _, doc, ws in words:
        for i in range(len(ws) - 49):
            key = tuple(ws[i : i + 50])
            first[key] = min(first.get(key, doc), doc)
    made = []
    for d, doc, ws in words:
        gone = set()
        for i in range(len(ws) - 49):
            if first[tuple(ws[i : i + 50])] < doc:
                gone.update(range(i, i + 50))
        made.append((d, len(ws), len(gone), " ".join(w for i, w in enumerate(ws) if i not in gone)))
    return sorted(made, key=str)


def found(frame):
    left = lempel_ziv.remove_passages(frame)
    return sorted(((r.doc_id, r.n_words, r.n_removed, bytes(r.kept).decode("utf-8", "surrogatepass")) for r in left.collect()), key=str)


def words(r, n, vocabulary=400):
    return [f"w{r.randrange(vocabulary)}" for _ in range(n)]


@pytest.mark.parametrize("seed", range(12))
def test_windows_of_a_block_equal_brute_force(seed):
    r = random.Random(seed)
    window = r.choice([4, 6, 9])
    docs = sorted(r.randrange(12) for _ in range(r.randrange(1, 25)))
    passages = [np.array([r.randrange(3) for _ in range(r.randrange(window, 40))], np.uint64) for _ in docs]
    got = lempel_ziv.Reference(passages, np.array(docs)).repeated(window)
    starts = lambda p: [tuple(p[q : q + window].tolist()) for q in range(len(p) - window + 1)]
    for i, passage in enumerate(passages):
        earlier = {w for j in range(i) if docs[j] < docs[i] for w in starts(passages[j])}
        assert got[i].tolist() == [q for q, w in enumerate(starts(passage)) if w in earlier]


def test_factors_are_longest_matches_with_earlier_documents():
    passages = [np.array(list(p), np.uint64) for p in ([1, 2, 3, 4, 5], [3, 4, 5, 1, 2, 9], [5, 1, 2, 9, 9, 1])]
    passage, start, length = lempel_ziv.Reference(passages, np.array([0, 1, 2])).factors()
    by = [length[passage == k].tolist() for k in range(3)]
    assert by == [[0] * 5, [3, 2, 0], [4, 1, 1]]


def test_next_smaller():
    values = np.random.default_rng(0).integers(0, 9, 200)
    got = lempel_ziv.next_smaller(values)
    assert got.tolist() == [next((j for j in range(i + 1, 200) if values[j] < values[i]), 200) for i in range(200)]


def test_shared_passages_in_different_surroundings(spark, monkeypatch):
    """A passage that most documents share, cut at all places, beside exact copies; crowded anchors are split to the end."""
    monkeypatch.setattr(lempel_ziv, "MOST_PASSAGES", 3)
    monkeypatch.setattr(lempel_ziv, "BLOCK_PASSAGES", 50)
    r = random.Random(5)
    shared, line = words(r, 120), words(r, 50)
    rows = []
    for i in range(80):
        a, b = sorted((r.randrange(121), r.randrange(121)))
        middle = shared[a:b] if i % 3 else shared
        rows.append((i * 7 % 80, " ".join(words(r, r.randrange(40)) + middle + words(r, r.randrange(40)) + (line if i % 4 == 0 else []) + words(r, 9))))
    rows += [(200 + i, rows[3][1]) for i in range(20)] + [(5, rows[8][1])]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    assert found(frame) == brute(rows)


def test_periodic_texts_and_a_very_long_one(spark):
    r = random.Random(2)
    long = words(r, 30_000, 5000)
    rows = [(1, "a " * 130), (2, "a " * 70), (3, "a b " * 60), (4, "b a " * 60 + "c"), (5, " ".join(long)), (6, " ".join(long[20_000:20_090])), (7, "a " * 49)]
    assert found(spark.createDataFrame(rows, "doc_id long, text string")) == brute(rows)


def test_messy_and_empty_rows(spark, messy, empty):
    rows = [(r.doc_id, r.text) for r in messy.collect()]
    assert found(messy) == brute(rows)
    assert found(empty) == []
    prose = " ".join(words(random.Random(1), 60))
    rows = [(None, prose), (None, prose), (4, prose), (4, prose), (9, "é " + prose.replace(" ", "\t\n")), (10, " ".join(["x"] * 60))]
    assert found(spark.createDataFrame(rows, "doc_id long, text string")) == brute(rows)


def test_spans_are_reported(spark):
    prose = words(random.Random(1), 60)
    rows = [(1, " ".join(prose)), (2, "x y " + " ".join(prose) + " z")]
    left = lempel_ziv.remove_passages(spark.createDataFrame(rows, "doc_id long, text string")).where(F.col("doc_id") == 2).first()
    assert [tuple(s) for s in left.removed] == [(2, 62)] and bytes(left.kept) == b"x y z"
