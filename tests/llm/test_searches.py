"""MaxScore, sharding and WARC archives against plain versions."""

import gzip
import hashlib
import io
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from marketflow.llm import maxscore, splitters, warc

from .conftest import messy_rows


def brute(queries, docs, k, skip):
    found = []
    for qid, q in queries:
        scored = sorted(((-sum(q.get(t, 0) * w for t, w in d.items()), did) for did, d in docs if not (skip and did == qid)))
        found += [(qid, r + 1, did, float(-s)) for r, (s, did) in enumerate(scored[:k])]
    return sorted(found)


@pytest.mark.parametrize("seed", range(3))
def test_maxscore_equals_brute_force(spark, monkeypatch, seed):
    monkeypatch.setattr(maxscore, "SHARD_DOCS", 40)
    monkeypatch.setattr(maxscore, "QUERY_BLOCK", 7)
    r = random.Random(seed)
    # few weights, so that there are many ties; sparse terms, one in all documents, some documents without any
    docs = [(i, {t: r.choice([-2, -1, 1, 2, 5]) for t in range(12) if t == 3 or r.random() < 0.2} if i % 17 else {}) for i in range(150)]
    queries = [(i, d) for i, d in docs if i % 10 == 0]
    schema = "id long, terms array<int>, weights array<double>"
    frame = lambda rows: spark.createDataFrame([(i, [*d], [float(w) for w in d.values()]) for i, d in rows], schema)
    found = maxscore.top_k(frame(queries).withColumnRenamed("id", "query_id"), frame(docs).withColumnRenamed("id", "doc_id"), 5, True)
    assert sorted(map(tuple, found.collect())) == brute(queries, docs, 5, True)


def test_maxscore_skips_nulls_and_takes_all_of_few(spark):
    schema = "id long, terms array<int>, weights array<double>"
    docs = spark.createDataFrame([(1, [1], [2.0]), (2, None, None), (None, [1], [9.0]), (3, [], [])], schema)
    found = maxscore.top_k(docs.withColumnRenamed("id", "query_id"), docs.withColumnRenamed("id", "doc_id"), 5)
    assert sorted(map(tuple, found.collect())) == [(1, 1, 1, 4.0), (1, 2, 3, 0.0), (3, 1, 1, 0.0), (3, 2, 3, 0.0)]
    none = docs.where("id = 99")
    assert maxscore.top_k(none.withColumnRenamed("id", "query_id"), docs.withColumnRenamed("id", "doc_id"), 5).count() == 0


def test_seed_threshold_never_exceeds_the_kth_score():
    random_numbers = np.random.default_rng(1)
    matrix = np.floor(random_numbers.normal(0, 20, (300, 8)))
    docs, dims = np.nonzero(matrix)
    weights = matrix[docs, dims]
    shard = maxscore.Shard(np.arange(300), docs, 2 * dims + (weights < 0), weights)
    for q in matrix[:20]:
        query = [(2 * i + s, q[i]) for i in np.flatnonzero(q) for s in (0, 1)]
        best, scores = shard.top(query, 5, None)
        order = np.lexsort((np.arange(300), -(matrix @ q)))[:5]
        assert best.tolist() == order.tolist() and scores.tolist() == (matrix @ q)[order].tolist()


def test_queries_in_batches_equal_brute_force_and_leave_few_documents_open(monkeypatch):
    monkeypatch.setattr(maxscore, "QUERY_BATCH", 16)
    random_numbers = np.random.default_rng(2)
    # 24 terms that half of the documents hold and 20 that one in forty holds; weights with a fraction
    matrix = random_numbers.normal(0, 1, (2000, 44)) * (random_numbers.random((2000, 44)) < [0.5] * 24 + [0.025] * 20)
    docs, terms = np.nonzero(matrix)
    shard, ids = maxscore.Shard(3 * np.arange(2000), docs, 3 * terms, matrix[docs, terms]), 3 * np.arange(2000)
    completed, products = [], maxscore.Shard._products
    monkeypatch.setattr(maxscore.Shard, "_products", lambda s, some, *rest: completed.append(len(some)) or products(s, some, *rest))
    asked = [(3 * np.arange(50), np.append(q, [1.0] * 6)) for q in matrix[:50]]
    found = list(shard.tops(asked, 5, ids[:50].tolist()))
    for i, (best, scores) in enumerate(found):
        full = matrix @ matrix[i]
        full[i] = -np.inf
        order = np.lexsort((ids, -full))[:5]
        assert best.tolist() == order.tolist() and scores == pytest.approx(full[order], rel=1e-12)
    assert sum(completed) < 0.1 * 50 * 2000


def placed(frame):
    return sorted(map(tuple, frame.select("doc_id", "size", "text_crc32", "shard", "slot").collect()), key=str)


def test_shards_are_cut_at_equal_bytes(spark, messy):
    rows = splitters.shard_documents(messy, 4).collect()
    sizes = {r["doc_id"]: r["size"] for r in rows}
    assert len(rows) == len(messy_rows()) and sizes[1] == sizes[2] == 1
    crc = {r["doc_id"]: r["text_crc32"] for r in rows}
    assert crc[6] == zlib.crc32(b"word") and crc[1] == 0
    total, before = sum(r["size"] for r in rows), 0
    for r in sorted(rows, key=lambda r: (r["shard"], r["slot"])):
        assert r["shard"] == before * 4 // total
        before += r["size"]
    for shard in {r["shard"] for r in rows}:
        slots = sorted(r["slot"] for r in rows if r["shard"] == shard)
        assert slots == list(range(len(slots)))


def test_hot_key_is_cut_apart(spark):
    """A third of all rows and bytes share one key."""
    rows = spark.range(9000).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("k"), F.lit(10).cast("long").alias("size"))
    shards = splitters.shard_by_bytes(rows, "k", "size", 8).groupBy("shard").agg(F.sum("size").alias("b")).collect()
    assert len(shards) == 8 and max(r["b"] for r in shards) - min(r["b"] for r in shards) <= 20


def test_text_keys_and_empty_input(spark, empty):
    rows = spark.createDataFrame([(f"k{i:03d}", 1 + i % 5) for i in range(300)] + [(None, 3)], "k string, size long")
    made = splitters.shard_by_bytes(rows, "k", "size", 4).collect()
    by_key = sorted(made, key=lambda r: r["k"] or "")
    assert [r["shard"] for r in by_key] == sorted(r["shard"] for r in made)
    assert splitters.shard_documents(empty, 4).collect() == []


def test_overfull_ranges_are_subdivided(spark):
    rows = spark.range(4000).select(F.col("id").alias("k"), F.when(F.col("id") < 40, 5000).otherwise(1).cast("long").alias("size"))
    numbered = rows.withColumn("__row", F.monotonically_increasing_id())
    ranges = splitters.sampled_ranges(numbered, ["k", "__row"], "size", 64)
    held = numbered.groupBy(ranges.alias("r")).agg(F.sum("size").alias("b"), F.count("*").alias("n")).collect()
    share = (40 * 5000 + 3960) / 64
    assert all(r["b"] <= 3 * share + 5000 for r in held)


PAGES = [
    (1, "http://a/1", "<p>same</p>"),
    (2, "http://a/2", "<p>same</p>"),
    (9, None, "<p>same</p>"),
    (3, "http://a/\r\nx", None),
    (4, "http://a/4", ""),
    (5, "http://a/5", "é\r\n\r\nWARC/1.1\r\n" * 50_000),
    (None, "http://a/6", "<p>other</p>"),
]


def test_archives_come_back_whole(spark, tmp_path):
    pages = spark.createDataFrame(PAGES, "page_id long, url string, html string").withColumn("row", F.lit("clash"))
    rows = {r["page_id"]: r for r in warc.archive_pages(pages, f"file://{tmp_path}/w").collect()}
    assert len(rows) == len(PAGES)
    assert [rows[i]["record_type"] for i in (1, 2, 9, 3, 4, 5, None)] == ["revisit", "revisit", "response", "revisit"] + ["response"] * 3
    assert rows[1]["refers_to"] == 9 and rows[3]["refers_to"] == 4 and rows[9]["refers_to"] is None
    for page, _, html in PAGES:
        payload = (html or "").encode()
        assert rows[page]["payload_bytes"] == len(payload) and rows[page]["payload_digest"] == warc.sha1_base32(payload)
        if rows[page]["record_type"] == "response":
            assert bytes(rows[page]["payload"]) == payload
    # a member is a gzip file of its own, and the sidecar names its place
    for cdx in tmp_path.glob("w/members/*.cdx"):
        packed = cdx.with_suffix(".warc.gz").read_bytes()
        for line in cdx.read_text().splitlines():
            offset, length = map(int, line.split("\t")[:2])
            assert gzip.decompress(packed[offset : offset + length]).startswith(b"WARC/1.1\r\n")


def test_small_payloads_are_all_responses_and_ties_leave_one(spark, tmp_path):
    pages = spark.createDataFrame([(1, "u", "ab"), (2, "u", "ab"), (7, "u", "abcdef"), (7, "u", "abcdef")], "page_id long, url string, html string")
    rows = warc.archive_pages(pages, f"file://{tmp_path}/w", least_bytes=3).select("page_id", "record_type", "refers_to").collect()
    assert sorted(map(tuple, rows), key=str) == [(1, "response", None), (2, "response", None), (7, "response", None), (7, "revisit", 7)]
    assert warc.archive_pages(pages.limit(0), f"file://{tmp_path}/none").count() == 0


def test_whole_stream_and_members_parse_alike():
    records = [warc._record(i, "u", b"x" * (i * 70_000), "response", None) for i in range(4)]
    for packed in (gzip.compress(b"".join(records)), b"".join(map(gzip.compress, records))):
        assert [data for _, data in warc.records_of(io.BytesIO(packed))] == records
    with pytest.raises(EOFError):
        list(warc.records_of(io.BytesIO(gzip.compress(b"".join(records))[:-2000])))
    assert hashlib.sha1(b"").hexdigest()[:4] == "da39"


def test_rows_are_told_apart_by_row_not_by_id(spark):
    rows = [(0, [2.0, 1.0]), (0, [2.0, 1.0]), (1, [3.0, 0.0]), (2, [0.0, -1.0]), (None, [9.0, 9.0])]
    vectors = spark.createDataFrame(rows, "vec_id long, v array<double>")
    found = sorted(map(tuple, maxscore.top_k_rows(vectors, F.col("vec_id") == 0, 3).collect()), key=str)
    # each of the two rows finds the other, and the row without an id
    assert found == sorted([(0, 1, None, 27.0), (0, 2, 1, 6.0), (0, 3, 0, 5.0)] * 2, key=str)
    assert maxscore.top_k_rows(vectors.where("vec_id > 9"), F.col("vec_id") == 0, 3).count() == 0
