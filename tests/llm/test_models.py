"""Trained operators: exact parts against brute force, the rest by what they must tell apart."""

import itertools
import math
import random
import tracemalloc
from collections import Counter
from zlib import crc32

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from marketflow.llm import deobfuscation, hidden_markov, linear, mixing, ordinal
from marketflow.llm.common import words

from .conftest import messy_rows

GOOD = "the river runs past green hills and small towns where people meet to sing about the sea".split()


def toxic_frames(spark, n=240):
    r = random.Random(2)
    rows, labels = [], []
    for i in range(n):
        text = [r.choice(GOOD) for _ in range(40)]
        bad = i % 4 == 0
        if bad:
            text[r.randrange(40)] = r.choice(["grumpfish", "snotbag"])
        rows.append((i, " ".join(text)))
        labels.append((i, 1, int(bad)))
    return spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_disguised_words_are_restored_and_scored(spark):
    docs, labels = toxic_frames(spark)
    model = deobfuscation.fit(docs, labels)
    texts = ["a gr0mpf1sh".replace("0", "u"), "gr*mpfish", "g r u m p f i s h", "grrrrumpf1$h!!!", "$n0tb@g", "s.n.o.t.b.a.g", "the river runs", "", None]
    frame = spark.createDataFrame([(i, t, "keep") for i, t in enumerate(texts)], "doc_id long, text string, toxicity string")
    rows = deobfuscation.score(frame, model, restored=True).orderBy("doc_id").collect()
    for r in rows[:6]:
        assert r["toxicity"] >= 0.7 and ("grumpfish" in r["restored"] or "snotbag" in r["restored"]), r
    assert all(r["toxicity"] < 0.3 for r in rows[6:])


def test_viterbi_equals_all_paths():
    counts = np.random.default_rng(1).integers(0, 50, deobfuscation.LETTERS**3).astype(float)
    model = deobfuscation.CharacterModel(counts)

    def paths(token, at):
        if at == len(token):
            yield "", 0.0
            return
        for end, letters, cost in model.arcs(token, at):
            for rest, more in paths(token, end):
                yield letters + rest, cost + more

    for token in ("1d10t", "h3ll0!!", "aaab", "w*rd", "$5", "x--y", "l33333t"):
        read, score = model.decode(token)
        best = max(model.word(p) - c for p, c in paths(token, 0))
        assert score == pytest.approx(best) and any(p == read for p, _ in paths(token, 0))


def test_toxicity_of_messy_rows(spark, messy, empty, label_frame):
    model = deobfuscation.fit(messy, label_frame)
    rows = deobfuscation.score(messy, model).collect()
    assert len(rows) == len(messy_rows()) and all(0 <= r["toxicity"] <= 1 for r in rows)
    nothing = deobfuscation.fit(empty, label_frame.limit(0))
    assert deobfuscation.score(empty, nothing).count() == 0
    assert deobfuscation.score(messy, nothing).first()["toxicity"] == pytest.approx(0.5)


def test_ordinal_gradient_and_order():
    r = np.random.default_rng(4)
    x = r.normal(size=(900, 3))
    truth = np.digitize(x @ [2.0, -1.0, 0.5] + r.logistic(size=900), [-1, 0.5, 2])
    at, columns = np.repeat(np.arange(900), 3), np.tile(np.arange(3), 900)
    weights, cuts = linear.fit_ordinal(at, columns, x.ravel(), truth, 4, 3, steps=600)
    assert np.all(np.diff(cuts) > 0)
    assert weights == pytest.approx([2, -1, 0.5], abs=0.35) and cuts == pytest.approx([-1, 0.5, 2], abs=0.4)


def test_quality_tells_grades_apart(spark, messy, empty, label_frame):
    r = random.Random(3)
    rows, rated = [], []
    for i in range(180):
        grade = i % 3
        text = [r.choice(GOOD) if r.random() < grade / 2 else r.choice(["###", "buy|now", "zz99"]) for _ in range(60)]
        rows.append((i, " ".join(text)))
        if i < 120:
            rated.append((i, grade))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    model = ordinal.fit(docs, spark.createDataFrame(rated, "doc_id long, label int"), 3)
    held = [r for r in ordinal.grade(docs, model).collect() if r["doc_id"] >= 120]
    mean = [np.mean([x["expected_grade"] for x in held if x["doc_id"] % 3 == g]) for g in range(3)]
    assert mean[0] < 0.5 < mean[1] < 1.5 < mean[2]
    for x in held:
        assert x["tails"][0] >= x["tails"][1] and x["expected_grade"] == pytest.approx(sum(x["tails"]))
    rated = label_frame.where("quality is not null").select("doc_id", ordinal.grades_of_labels().alias("label"))
    assert ordinal.grade(messy, ordinal.fit(messy, rated, 3)).count() == messy.count()
    even = ordinal.fit(empty, rated.limit(0), 3)
    assert ordinal.grade(empty, even).count() == 0
    assert ordinal.grade(messy, even).first()["expected_grade"] == pytest.approx(1.0)


def test_rates_meet_their_targets(spark):
    r = np.random.default_rng(6)
    p = r.dirichlet([0.5, 0.2, 0.3], 800)
    rows = [(i, i, int(t), *map(float, q)) for i, (t, q) in enumerate(zip(r.integers(1, 500, 800), p))]
    held = spark.createDataFrame(rows, "row long, doc_id long, tokens long, p0 double, p1 double, p2 double")
    targets = [0.7, 0.02, 0.28]
    history, reached = mixing.fit_rates(held, targets)
    rated = mixing.apply_rates(held, history, 3).toPandas()
    share = rated.tokens / rated.tokens.sum()
    for d, goal in enumerate(targets):
        assert (share * rated.rate * rated[f"p{d}"]).sum() == pytest.approx(goal, abs=2e-4)
    assert (rated.rate >= 0).all() and (abs(rated.copies - rated.rate) < 1).all()
    # targets that the bounds forbid: the result is the least-squares fit, as slow plain descent finds it
    history, reached = mixing.fit_rates(held, [0.0, 1.0, 0.0], 0.5, 2.0)
    w, x, goal = (rated.tokens / rated.tokens.sum()).to_numpy(), np.ones(800), np.array([0.0, 1.0, 0.0])
    for _ in range(4000):
        x = np.clip(x - 1.5 * p @ ((x * w) @ p - goal), 0.5, 2.0)
    best = (((x * w) @ p - goal) ** 2).sum()
    assert ((reached - goal) ** 2).sum() <= best * 1.02 + 1e-8


def test_memberships_hold_a_bounded_part_of_a_batch():
    """Eight megabytes of text in one batch take far less than the fifty-fold that their features would at once."""
    texts = [" ".join(f"w{(i * 31 + k * 17) % 4999}" for k in range(400)) for i in range(3500)]
    ids = pa.array(range(len(texts)), pa.int64())
    batch = pa.RecordBatch.from_arrays([ids, ids, pa.array([t.encode() for t in texts])], names=["row", "doc_id", "text"])
    weights = np.random.default_rng(4).normal(size=((1 << 16) + 1, 3))
    tracemalloc.start()
    tokens = [n for made in mixing._members(iter([batch]), weights) for n in made.column("tokens").to_pylist()]
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert tokens == [400] * len(texts) and peak < 40_000_000


def test_mixing_of_messy_rows(spark, messy, empty, label_frame):
    labelled = label_frame.select("doc_id", mixing.domain_of_labels().alias("label"))
    mixed = mixing.mix(messy, labelled, [0.6, 0.2, 0.2])
    assert mixed.columns == messy.columns and mixed.distinct().count() == messy.distinct().count()
    assert mixing.mix(empty, labelled, [0.6, 0.2, 0.2]).count() == 0
    rated, _ = mixing.rates(messy, labelled.limit(0), [0.6, 0.2, 0.2])
    assert {round(r["p0"], 6) for r in rated.collect()} == {round(1 / 3, 6)}


def test_forward_equals_all_state_paths():
    r = np.random.default_rng(8)
    chain = hidden_markov.Chain(r.dirichlet(np.ones(3)), r.dirichlet(np.ones(3), 3), r.dirichlet(np.ones(5), 3).T)
    texts = [r.integers(0, 5, n) for n in (1, 2, 4, 6, 6)]
    for text, log in zip(texts, hidden_markov.log_likelihoods(texts, chain)):
        total = 0.0
        for path in itertools.product(range(3), repeat=len(text)):
            p = chain.start[path[0]] * chain.emit[text[0], path[0]]
            for a, b, x in zip(path, path[1:], text[1:]):
                p *= chain.move[a, b] * chain.emit[x, b]
            total += p
        assert log == pytest.approx(math.log(total))
    # expected counts by differentiation of the log likelihood
    counts = hidden_markov.expected_counts(texts, chain)
    assert counts[0].sum() == pytest.approx(len(texts)) and counts[4:].sum() == pytest.approx(sum(map(len, texts)))
    step = 1e-6
    for a, b in itertools.product(range(3), repeat=2):
        move = chain.move.copy()
        move[a, b] += step
        slope = (hidden_markov.log_likelihoods(texts, hidden_markov.Chain(chain.start, move, chain.emit)).sum() - hidden_markov.log_likelihoods(texts, chain).sum()) / step
        assert counts[1 + a, b] == pytest.approx(chain.move[a, b] * slope, rel=1e-3)


def test_recursions_lay_texts_out_by_place():
    r = np.random.default_rng(10)
    chain = hidden_markov.Chain(r.dirichlet(np.ones(4)), r.dirichlet(np.ones(4), 4), r.dirichlet(np.ones(9), 4).T)
    texts = [r.integers(0, 9, n) for n in (7, 7, 5, 1, 1)]
    seen, stops = hidden_markov._by_time(texts)
    assert [seen[a:b].tolist() for a, b in zip(stops, stops[1:])] == [[t[k] for t in texts if len(t) > k] for k in range(7)]
    # in any order and any blocks the sums are those of the texts one by one
    alone = sum(hidden_markov.expected_counts([t], chain) for t in texts)
    together = hidden_markov.expected_counts([texts[k] for k in (3, 0, 4, 2, 1)], chain)
    assert together == pytest.approx(alone, rel=1e-12) and together[5:].sum() == pytest.approx(21)
    logs = [hidden_markov.log_likelihoods([t], chain)[0] for t in texts]
    assert hidden_markov.log_likelihoods(texts, chain) == pytest.approx(logs, rel=1e-12)


def test_turns_never_lower_the_likelihood():
    r = np.random.default_rng(9)
    texts = [r.integers(0, 40, r.integers(1, 60)) // (1 + k % 2) for k in range(40)]
    shares = np.full(40, 1 / 40)
    chain, last = hidden_markov.initial(shares, 3), -np.inf
    for _ in range(8):
        now = hidden_markov.log_likelihoods(texts, chain).sum()
        assert now > last - 0.5  # smoothing may give back a little
        chain, last = hidden_markov.improved(hidden_markov.expected_counts(texts, chain), shares), now


def test_scores_of_messy_rows(spark, messy, empty):
    rows = hidden_markov.score(messy).collect()
    learnt = [t for i, t, *_ in messy_rows() if i is None or crc32(str(i).encode()) % 5 != 1]
    c = Counter(w for t in learnt for w in words(t)) + Counter({"\n": len(learnt)})
    n, v = sum(c.values()), len(c)
    base = Counter()
    for _, t, *_ in messy_rows():
        tokens = [*words(t), "\n"]
        base[(len(tokens), sum(w in c for w in tokens), round(sum(math.log10((c[w] + 0.5) / (n + 0.5 * (v + 1))) for w in tokens), 6))] += 1
    assert Counter((r["n_tokens"], r["n_known"], round(r["base_score"], 6)) for r in rows) == base
    assert all(r["train_tokens"] == n and r["score"] < 0 for r in rows)
    assert hidden_markov.score(empty).count() == 0


def test_scores_do_not_depend_on_which_words_every_task_knows(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    shown = lambda share: {r["doc_id"]: r for r in hidden_markov.score(docs, known_share=share).collect()}
    every, some = shown(hidden_markov.KNOWN), shown(hidden_markov.FREQUENT)
    assert every.keys() == some.keys()
    for i, r in every.items():
        assert (r["n_tokens"], r["n_known"]) == (some[i]["n_tokens"], some[i]["n_known"])
        assert r["score"] == pytest.approx(some[i]["score"], rel=1e-9) and r["base_score"] == pytest.approx(some[i]["base_score"], rel=1e-9)
    held = [r for r in every.values() if r["held_out"]]
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held)


def test_every_turn_of_the_chain_runs_over_all_training_rows(spark, monkeypatch):
    docs = spark.createDataFrame([(i, " ".join(f"w{(i * 7 + k) % 11}" for k in range(12))) for i in range(900)], "doc_id long, text string")
    learnt = sum(crc32(str(i).encode()) % 5 != 1 for i in range(900))
    begun, turn = [], hidden_markov.baum_welch

    def watched(encoded, chain, classes):
        begun.append((encoded.count(), chain, classes))
        return turn(encoded, chain, classes)

    monkeypatch.setattr(hidden_markov, "baum_welch", watched)
    hidden_markov.score(docs, turns=2)
    assert [n for n, _, _ in begun] == [learnt, learnt]
    # nothing was learnt from a part of the rows before
    first = hidden_markov.initial(begun[0][2])
    assert np.array_equal(begun[0][1].emit, first.emit) and np.array_equal(begun[0][1].move, first.move)


def test_pipeline_stages_work_on_what_is_left(spark):
    import corpus_pipeline

    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    done = corpus_pipeline.run(spark, folder)
    kept = {r["doc_id"] for r in done.select("doc_id").collect()}
    assert kept < {r["doc_id"] for r in docs.collect()} and set(done.columns) == {"doc_id", "size", "text_crc32", "shard", "slot"}
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    from .test_duplicates import classes, leaked

    rows = [(i, texts[i]) for i in kept]
    root, _ = classes(rows, 5, 80)
    assert len(set(root)) == len(rows)
    items = spark.read.parquet(f"{folder}/benchmark.parquet").collect()
    assert not any(leaked(t, x["text"]) for _, t in rows for x in items)
    assert done.groupBy("doc_id").count().agg(F.max("count")).first()[0] <= 5


@pytest.mark.parametrize("length", [40, 474, 5000])
def test_letters_in_a_row_are_read_whatever_their_number(spark, length):
    docs, labels = toxic_frames(spark)
    model = deobfuscation.fit(docs, labels)
    spelled = " ".join("grumpfish" if k == length // 2 else GOOD[k % len(GOOD)] for k in range(length // 5))
    if length < 400:
        spelled = "meet a grumpfish and sing"
    else:
        spelled += " grumpfish"
    frame = spark.createDataFrame([(1, " ".join(spelled.replace(" ", ""))), (2, "x" + spelled.replace(" ", "-") + "!")], "doc_id long, text string")
    rows = deobfuscation.score(frame, model, restored=True).orderBy("doc_id").collect()
    # the ends of words are found too
    assert "grumpfish" in rows[0]["restored"].split() and rows[0]["toxicity"] >= 0.7
    assert "grumpfish" in rows[1]["restored"]


def test_texts_hashed_together_equal_texts_hashed_alone(messy):
    import pyarrow as pa

    from marketflow.llm import features, spans

    texts = [r.text for r in messy.collect()] + ["a a a b", "Ünïcode ünïcode X9 x9 x9"]
    data, offsets = spans.flat(pa.array(texts, pa.string()))
    hasher = features.Hasher()
    at, numbers, values, n = features.hashed_rows(spans.LOWER[data], offsets, hasher)
    for k, text in enumerate(texts):
        alone = features.hashed(text, features.Hasher())
        assert numbers[at == k].tolist() == alone[0].tolist() and values[at == k] == pytest.approx(alone[1])
        assert n[k] == len(words(text))


def test_rates_end_where_nothing_can_be_gained(spark, caplog):
    r = np.random.default_rng(6)
    p = r.dirichlet([0.5, 0.2, 0.3], 400)
    rows = [(i, i, 10, *map(float, q)) for i, q in enumerate(p)]
    held = spark.createDataFrame(rows, "row long, doc_id long, tokens long, p0 double, p1 double, p2 double")
    _, reached = mixing.fit_rates(held, [0.92, 0.0, 0.08], 1.0, 4.0)
    assert "keep the shares from their targets" in caplog.text and (reached >= p.mean(0) - 1e-9).all()


def test_ratings_need_both_labels(spark):
    rows = [(1, 1, 0), (2, 1, 1), (3, 0, 1), (4, 1, None), (5, None, 1), (6, 0, None)]
    frame = spark.createDataFrame(rows, "doc_id long, quality int, toxic int")
    assert [x[0] for x in frame.select(ordinal.grades_of_labels()).collect()] == [2, 1, 0, None, None, None]


CLASHING = {"lang": "toxicity", "row": "restored", "label": "row", "key": "__key", "tokens": "kept_0"}


def test_stages_keep_all_values_of_columns_of_any_name(spark, messy, label_frame):
    from marketflow.llm import spaced_seeds, tensor_minhash

    docs = messy.withColumnsRenamed(CLASHING)
    docs = docs.withColumn("row", F.monotonically_increasing_id() * 7 + 100)
    given = {str(r) for r in docs.collect()}
    model = deobfuscation.fit(docs, label_frame)
    tests = spark.createDataFrame([(1, "no such passage of the benchmark is in any of the given texts at all")], "item_id long, text string")
    labelled = label_frame.select("doc_id", mixing.domain_of_labels().alias("label"))
    for kept in (
        deobfuscation.clean(docs, model, below=2.0),
        tensor_minhash.keep_one_each(docs),
        spaced_seeds.decontaminate(docs, tests),
        mixing.mix(docs, labelled, [0.6, 0.2, 0.2]),
    ):
        assert kept.columns == docs.columns
        rows = {str(r) for r in kept.collect()}
        assert rows and rows <= given


def test_fit_of_domains_holds_few_copies_of_its_entries():
    """Entries in the order of rows are not copied for it; a worker trains beside what its earlier tasks left."""
    r = np.random.default_rng(0)
    at = np.repeat(np.arange(2000, dtype=np.int32), 200)
    columns, values = r.integers(0, 1 << 16, len(at), np.int32), r.random(len(at))
    tracemalloc.start()
    linear.fit_softmax(at, columns, values, r.integers(0, 3, 2000), 3, 1 << 16, steps=2)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    # of the descent: three copies of 65537 weights in a handful of arrays
    assert peak < 5 * values.nbytes + 8 * 3 * 8 * (1 << 16)


def test_workers_keep_nothing_of_a_task():
    import weakref

    from marketflow.llm.common import releasing

    class Cache:
        def __init__(self):
            self.me = self

    left = []

    def run(batches):
        cache = Cache()
        left.append(weakref.ref(cache))
        yield from batches

    assert list(releasing(run)(iter([1, 2]))) == [1, 2]
    assert left[0]() is None
