"""Near duplicates, repeated strings and benchmark leaks against brute force."""

import os
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from marketflow.llm import lyndon_suffixes, spaced_seeds, tensor_minhash
from marketflow.llm.common import words
from marketflow.llm.components import components
from marketflow.session import settle

from .conftest import messy_rows


def shingles(text, size):
    found = words(text)
    take = min(size, len(found))
    return {tuple(found[i : i + take]) for i in range(len(found) - take + 1)} if found else set()


def classes(rows, size, percent):
    """Class of each row by union-find over all pairs."""
    sets, root = [shingles(t, size) for _, t in rows], list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if a and sets[j] and 100 * both >= percent * (len(a) + len(sets[j]) - both):
                root[find(i)] = find(j)
    return [find(i) for i in range(len(rows))], [len(s) for s in sets]


def near_copies(seed, groups=6, copies=12, changed=12):
    r = random.Random(seed)
    rows = []
    for g in range(groups):
        base = [f"g{g}w{r.randrange(60)}" for _ in range(r.choice([3, 40, 120]))]
        for _ in range(copies):
            text = list(base)
            for _ in range(r.randrange(0, 1 + len(base) // changed)):
                text[r.randrange(len(text))] = f"e{r.randrange(10**6)}"
            rows.append((len(rows) + 10, " ".join(text)))
    return rows


@pytest.mark.parametrize("size,rounds,percent,changed", [(2, 2, 80, 12), (5, 0, 80, 12), (2, 0, 80, 6), (2, 0, 50, 3), (2, 0, 60, 4), (2, 0, 90, 20)])
def test_classes_equal_all_pairs(spark, monkeypatch, size, rounds, percent, changed):
    monkeypatch.setattr(tensor_minhash, "PIVOT_ROUNDS", rounds)
    rows = near_copies(size, changed=changed)
    found, _ = tensor_minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), size, percent)
    root, counts = classes(rows, size, percent)
    least = {}
    for (i, _), k in zip(rows, root):
        least[k] = min(least.get(k, i), i)
    expected = sorted((i, n, least[k]) for (i, _), k, n in zip(rows, root, counts))
    assert sorted(map(tuple, found.select("doc_id", "n_shingles", "component_id").collect())) == expected


def test_words_of_long_texts_are_hashed_in_blocks(monkeypatch):
    r = random.Random(2)
    texts = ["", "a " * 300, "x" * 500, " ".join("b" * r.randrange(1, 90) for _ in range(200)), " \n", "c d"]
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    offsets = np.cumsum([0] + [len(t) for t in texts])
    whole = [h.tolist() for part in tensor_minhash.word_hashes(data, offsets) for h in part]
    assert [len(h) for h in whole] == [len(words(t)) for t in texts]
    for size in (1, 7, 64):
        monkeypatch.setattr(tensor_minhash, "BLOCK_BYTES", size)
        assert [h.tolist() for part in tensor_minhash.word_hashes(data, offsets) for h in part] == whole


def test_tables_follow_the_similarity():
    assert tensor_minhash.banding(80) == (14, 3)
    for percent in range(5, 101, 5):
        width, depth = tensor_minhash.banding(percent)
        missed = 1 - (1 - (1 - (percent / 100) ** depth) ** width) ** 2
        assert missed <= tensor_minhash.MISSED


def test_copies_that_differ_too_much_make_few_pairs(spark):
    r = random.Random(1)
    base = [f"w{k}" for k in range(80)]
    rows = []
    for row in range(200):
        text = list(base)
        for place in r.sample(range(80), 8):
            text[place] = f"x{row}y{place}"
        rows.append((row, " ".join(text)))
    # one pair that is linked
    rows.append((200, rows[0][1] + " end"))
    numbered = spark.createDataFrame(rows, "row long, text string")
    nodes = numbered.select(numbered["row"].alias("node"), numbered["row"].alias("label"))
    pairs = tensor_minhash._pairs_between(nodes, numbered, 2, 80).distinct().collect()
    assert (0, 200) in [tuple(p) for p in pairs]
    sets = [shingles(t, 2) for _, t in rows]
    linked = {(j, i) for i, a in enumerate(sets) for j in range(i) if 100 * len(a & sets[j]) >= 80 * len(a | sets[j])}
    assert linked <= {tuple(p) for p in pairs} and len(pairs) < 1000


def test_links_are_verified_by_one_join_of_sets(spark, monkeypatch):
    """A set goes to the nodes that it is compared with in one shuffle, not by both ends of a pair in turn."""
    rows = [(r, text) for r, (_, text) in enumerate(near_copies(3, groups=3))]
    numbered = spark.createDataFrame(rows, "row long, text string")
    sets = [shingles(t, 2) for _, t in rows]
    signed = spark.createDataFrame([(r, len(s)) for r, s in enumerate(sets)], "node long, n_shingles long")
    pairs = [(a, b) for b in range(len(rows)) for a in range(b) if (a + b) % 3]
    plans = {}

    def settled(frame, label="settled"):
        plans[label] = frame._jdf.queryExecution().optimizedPlan().toString()
        return settle(frame, label)

    monkeypatch.setattr(tensor_minhash, "settle", settled)
    found = tensor_minhash._verified(spark.createDataFrame(pairs, "a long, b long"), numbered, signed, 2, 80).collect()
    linked = lambda a, b: 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])
    assert sorted(map(tuple, found)) == sorted(p for p in pairs if linked(*p))
    assert plans["verified"].count("Join ") == 1 and "broadcast" not in plans["verified"]


def test_numbered_texts_take_less_disk_than_a_plain_copy(spark):
    r = random.Random(4)
    vocabulary = ["".join(r.choice("abcdefghij") for _ in range(r.randrange(2, 10))) for _ in range(3000)]
    rows = [(i, " ".join(r.choice(vocabulary) for _ in range(300))) for i in range(400)] + [(None, None), (400, ""), (0, "é 漢字")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    _, numbered = tensor_minhash.near_duplicates(docs)
    size = lambda frame: sum(os.path.getsize(name.removeprefix("file://")) for name in frame.inputFiles())
    assert size(numbered) < 0.8 * size(settle(docs))
    assert sorted(map(tuple, numbered.select("doc_id", "text").collect()), key=str) == sorted(rows, key=str)


def test_messy_rows_keep_one_of_each(spark, messy, empty):
    kept = tensor_minhash.keep_one_each(messy, size=5)
    assert kept.columns == messy.columns
    ids = [r["doc_id"] for r in kept.collect()]
    # the three rows of one text are one, blank texts stay
    assert sorted(ids, key=str) == sorted([1, 2, 3, 4, 6, 7, 8, None], key=str)
    assert tensor_minhash.keep_one_each(empty).count() == 0


def test_components_of_a_chain_and_a_star(spark):
    links = [(i, i + 1) for i in range(1, 40)] + [(100, 100 + i) for i in range(1, 30)] + [(7, 7)]
    found = components(spark.createDataFrame(links, "a long, b long")).collect()
    assert {(r["node"], r["label"]) for r in found} == {(i, 1) for i in range(1, 41)} | {(100 + i, 100) for i in range(30)}


def test_suffix_array_of_random_texts():
    r = random.Random(1)
    for _ in range(800):
        text = [r.randrange(r.choice([1, 2, 3, 9])) for _ in range(r.randrange(60))]
        assert lyndon_suffixes.suffix_array(text) == sorted(range(len(text)), key=lambda i: text[i:])


def stripped(texts, length=200):
    data = [(t or "").encode() for t in texts]
    seen = Counter(b[k : k + length] for b in data for k in range(len(b) - length + 1))
    made = []
    for b in data:
        gone = bytearray(len(b))
        for k in range(len(b) - length + 1):
            if seen[b[k : k + length]] > 1:
                gone[k : k + length] = b"\1" * length
        made.append((len(b), sum(gone), sum(1 for k in range(len(gone)) if gone[k] and not (k and gone[k - 1])), bytes(x for x, g in zip(b, gone) if not g)))
    return made


@pytest.mark.parametrize("array_bytes", [200_000, 3000])
def test_repeats_equal_brute_force(spark, monkeypatch, array_bytes):
    """The small array sends anchors with many surroundings the way of counted windows."""
    monkeypatch.setattr(lyndon_suffixes, "ARRAY_BYTES", array_bytes)
    r = random.Random(5)
    word = lambda: "".join(r.choice("abcdé ") for _ in range(r.randrange(1, 9)))
    passage = " ".join(word() for _ in range(70))
    texts = [" ".join(word() for _ in range(40)) + passage[r.randrange(40) : -r.randrange(1, 40)] + word() for _ in range(30)]
    texts += ["ab" * 300, "x" * 199, "y" * 201, texts[0], None, "", passage[:199], passage[:200]]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = {x["doc_id"]: x for x in lyndon_suffixes.remove_repeats(docs).collect()}
    for i, expected in enumerate(stripped(texts)):
        x = rows[i]
        assert (x["n_bytes"], x["n_removed"], len(x["removed"]), bytes(x["kept"])) == expected, i


def test_recoded_pieces_equal_brute_force():
    """An anchor is one symbol and what follows is packed: far fewer symbols than bytes, the same windows."""
    r = random.Random(1)
    for _ in range(200):
        anchor = r.choice([1, 3, 5])
        length = anchor + r.randrange(30)
        some = lambda n, signs="ab": "".join(r.choice(signs) for _ in range(n))
        anchors, pieces, before = [some(anchor), some(anchor)], [], []
        for _ in range(r.randrange(1, 25)):
            at = r.randrange(length - anchor + 1)
            after = r.randrange(at + 1) + length - at - anchor
            pieces.append((some(at) + r.choice(anchors) + some(after, "ab\0\xff")).encode("latin1"))
            before.append(at)
        places = [range(len(p) - length + 1) for p in pieces]
        seen = Counter((at - k, p[k : k + length]) for p, at, ks in zip(pieces, before, places) for k in ks)
        every = Counter(p[k : k + length] for p, ks in zip(pieces, places) for k in ks)
        for p, at, ks, flags in zip(pieces, before, places, lyndon_suffixes.repeated_windows(pieces, before, length, anchor)):
            assert len(flags) == len(ks)
            assert all((seen[at - k, p[k : k + length]] > 1) <= bool(f) <= (every[p[k : k + length]] > 1) for k, f in zip(ks, flags))
    text, _ = lyndon_suffixes.recoded([bytes(range(250))] * 4, [75] * 4)
    assert len(text) == 4 * (75 + 1 + 10 + 1)


def test_crowded_anchors_are_counted(spark, monkeypatch):
    monkeypatch.setattr(lyndon_suffixes, "ARRAY_BYTES", 300)
    r = random.Random(6)
    word = lambda: "".join(r.choice("abcdé ") for _ in range(r.randrange(1, 9)))
    passage = " ".join(word() for _ in range(70))
    texts = [" ".join(word() for _ in range(40)) + passage[r.randrange(40) : -r.randrange(1, 40)] + word() for _ in range(30)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {x["doc_id"]: (x["n_removed"], bytes(x["kept"])) for x in lyndon_suffixes.remove_repeats(docs).collect()}
    assert found == {i: (removed, kept) for i, (_, removed, _, kept) in enumerate(stripped(texts))}


def test_repeats_of_messy_rows(spark, messy, empty):
    rows = lyndon_suffixes.remove_repeats(messy).collect()
    assert sorted(x["n_bytes"] for x in rows) == sorted(len((t or "").encode()) for _, t, *_ in messy_rows())
    assert lyndon_suffixes.remove_repeats(empty).count() == 0


def leaked(doc, item):
    w, v = ([x for x in __import__("regex").split(r"[^\p{L}\p{M}\p{N}]+", t.lower()) if x] for t in (doc, item))
    if len(v) < 5:
        return None
    best = None
    for shift in range(-len(v) + 1, len(w)):
        flags = [w[shift + q] == v[q] for q in range(len(v)) if 0 <= shift + q < len(w)]
        hit = any(sum(flags[s : s + 13]) >= 11 for s in range(len(flags) - 12)) if len(v) >= 13 else sum(flags) == len(v)
        if hit and (best is None or sum(flags) > best[0]):
            best = (sum(flags), len(v), shift)
    return best


def test_leaks_equal_brute_force(spark):
    r = random.Random(3)
    vocabulary = [f"w{i}" for i in range(25)]
    items = [(i, " ".join(r.choice(vocabulary) for _ in range(n))) for i, n in enumerate([4, 5, 8, 12, 13, 14, 30, 60])]
    docs = []
    for i in range(60):
        text = [r.choice(vocabulary) for _ in range(r.randrange(0, 40))]
        part = r.choice(items)[1].split()
        part = part[r.randrange(3) : len(part) - r.randrange(3)]
        for _ in range(r.randrange(4)):
            part[r.randrange(len(part))] = "other"
        at = r.randrange(len(text) + 1)
        docs.append((i, ", ".join(text[:at] + part + text[at:]).upper()))
    found = spaced_seeds.contaminations(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    expected = sorted((d, i, *hit) for d, t in docs for i, v in items if (hit := leaked(t, v)))
    assert sorted(map(tuple, found.collect())) == expected


def test_decontamination_of_messy_rows(spark, messy, empty):
    tests = spark.createDataFrame([(1, messy_rows()[0][1]), (None, None), (2, ""), (3, "word")], "item_id long, text string")
    kept = spaced_seeds.decontaminate(messy, tests)
    assert kept.columns == messy.columns
    assert sorted((r["doc_id"] for r in kept.collect()), key=str) == sorted([1, 2, 3, 6, 7, 8, None], key=str)
    assert spaced_seeds.decontaminate(empty, tests).count() == 0
    assert spaced_seeds.decontaminate(messy, tests.limit(0)).count() == messy.count()


def test_main_paths_run_no_python(spark, messy):
    tests = spark.createDataFrame([(1, "a b c d e f g")], "item_id long, text string")
    plan = spaced_seeds.contaminations(messy, tests)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan


def test_masks_find_every_window():
    for a in range(13):
        for b in range(a):
            assert any(
                all(o + p not in (a, b) for p in mask) for mask in spaced_seeds.MASKS for o in range(13 - mask[-1])
            )
