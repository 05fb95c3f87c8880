"""Importance resampling against a plain version; the interning table against dictionaries."""

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import xxhash

from marketflow.llm import resampling, spans

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def grams(text, order=2):
    ws = WORD.findall((text or "").translate(LOWER))
    return ws, [" ".join(ws[i : i + n]) for n in range(1, order + 1) for i in range(len(ws) - n + 1)]


def brute(rows, target, percent, least, buckets=10_000):
    count = lambda texts: Counter(zlib.crc32(g.encode()) % buckets for t in texts for g in grams(t)[1])
    s, t = count(x for _, x in rows), count(target)
    n, m = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1.0) * (m + buckets) / ((s[b] + 1.0) * (n + buckets)))) for b in range(buckets)]
    made = []
    for doc_id, text in rows:
        ws, gs = grams(text)
        weight = sum(gain[zlib.crc32(g.encode()) % buckets] for g in gs) // len(gs) if gs else 0
        h = int(hashlib.sha256(f"7:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        made.append([doc_id, len(gs), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, len(ws)])
    enough = sorted((x for x in made if x[5] >= least), key=lambda x: (-x[3], x[0] is None, x[0], x[1]))
    for rank, x in enumerate(enough[: percent * len(enough) // 100], 1):
        x[4] = rank
    return sorted((tuple(x[:5]) for x in made), key=str)


def found(frame):
    return sorted(map(tuple, frame.select("doc_id", "n_features", "weight", "score", "rank").collect()), key=str)


def test_hashes_are_xxh64_of_every_length():
    data = np.frombuffer(np.random.default_rng(0).bytes(600) + bytes(7), np.uint8)
    starts, lengths = np.arange(90) * 5, np.arange(90)
    got = resampling.xxhash64(data, starts, lengths)
    assert [int(h) for h in got] == [xxhash.xxh64_intdigest(data[a : a + n].tobytes()) for a, n in zip(starts, lengths)]


def test_equal_hashes_are_told_apart_by_their_bytes():
    parts = [b"one", b"two", b"one", b"twelve", b"two", b"twelve bytes and many more than one lane", b"twelve bytes and many more than one lanE"]
    data = np.frombuffer(b"".join(parts) + bytes(7), np.uint8)
    lengths = np.array([len(p) for p in parts])
    table = resampling.Interned(data, np.cumsum(lengths) - lengths, lengths, hashes=np.zeros(len(parts), np.uint64))
    slots = table.slot_of.tolist()
    assert len(set(slots)) == len(set(parts)) and slots[0] == slots[2] and slots[1] == slots[4]
    assert table.count[table.slot_of].tolist() == [parts.count(p) for p in parts]


def test_crc_of_joined_texts():
    pairs = [(b"abc", b""), (b"", b"x"), (b"word", b" next"), (b"a" * 9, bytes(range(200)))]
    got = resampling.crc_joined(*(np.array([zlib.crc32(p[k]) for p in pairs], np.uint32) for k in (0, 1)), np.array([len(p[1]) for p in pairs]))
    assert got.tolist() == [zlib.crc32(a + b) for a, b in pairs]


@pytest.mark.parametrize("order", [1, 2, 3])
def test_buckets_of_all_occurrences(monkeypatch, order):
    monkeypatch.setattr(resampling, "TABLE_WORDS", 7)
    texts = ["One two  three, two", None, "", "x", "é漢 a9 B" * 4, "one two three one two three"]
    data, offsets = spans.flat(pa.array(texts, pa.string()))
    counts = np.zeros(97, np.int64)
    words, rows, buckets = resampling.bucketed(spans.LOWER[data], offsets, 97, order, counts)
    assert words.tolist() == [len(grams(t)[0]) for t in texts]
    for k, text in enumerate(texts):
        assert sorted(buckets[rows == k].tolist()) == sorted(zlib.crc32(g.encode()) % 97 for g in grams(text, order)[1])
    assert counts.tolist() == np.bincount(buckets, minlength=97).tolist()


def test_messy_rows_equal_brute_force(spark, messy, empty):
    rows = [(r.doc_id, r.text) for r in messy.collect()]
    target = spark.createDataFrame([("quick brown fox",), (None,), ("the lazy dog",)], "text string")
    want = brute(rows, ["quick brown fox", None, "the lazy dog"], 50, 10)
    assert found(resampling.resample(messy.drop("row"), target, percent=50, least_words=10)) == want
    assert resampling.resample(empty.drop("row"), target).count() == 0
    none = target.where("text = 'none'")
    assert found(resampling.resample(messy.drop("row"), none, 50, 10)) == brute(rows, [], 50, 10)


def test_draw_keeps_every_column(spark, messy):
    target = spark.createDataFrame([("quick brown fox",)], "text string")
    clashing = messy.withColumnsRenamed({"label": "rank", "key": "weight", "tokens": "n_words"})
    drawn = resampling.draw(clashing, target, percent=100, least_words=1)
    assert drawn.columns == clashing.columns
    want = [r for r in clashing.collect() if grams(r.text)[0]]
    assert sorted(map(str, drawn.collect())) == sorted(map(str, want))


def test_more_of_the_target_is_drawn(spark):
    """Texts like the target are drawn far above the six of sixty that chance would give."""
    rows = [(i, " ".join(("near" if i % 10 == 0 else "far") + str((i * 31 + k * 17) % 50) for k in range(40))) for i in range(600)]
    target = spark.createDataFrame([(" ".join(f"near{(i * 7 + k) % 50}" for k in range(50)),) for i in range(20)], "text string")
    drawn = resampling.draw(spark.createDataFrame(rows, "doc_id long, text string"), target, percent=10).collect()
    assert len(drawn) == 60 and sum(r.doc_id % 10 == 0 for r in drawn) >= 36


def test_gains_divide_each_count_by_its_own_total():
    """The ratio of the shares (t + 1) / (T + n) and (s + 1) / (S + n), of totals that differ widely."""
    source, target = np.array([900, 90, 9, 0]), np.array([1, 0, 2, 0])
    want = [math.floor(1000 * math.log((t + 1) * (999 + 4) / ((s + 1) * (3 + 4)))) for s, t in zip(source.tolist(), target.tolist())]
    assert resampling.gains(source, target).tolist() == want
    # a target that is the corpus itself gains nothing anywhere, one without counts only where the corpus has few
    assert not resampling.gains(source, source).any()
    assert resampling.gains(source, np.zeros(4, np.int64)).tolist() == [math.floor(1000 * math.log(1003 / ((s + 1) * 4))) for s in source.tolist()]
