"""Queries of this package, `opN_<name>`, and the DuckDB twins of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketflow.llm import deobfuscation, hard_negatives, hidden_markov, lempel_ziv, lyndon_suffixes, maxscore, mixing, ordinal, resampling, spaced_seeds, splitters, tensor_minhash, warc
from marketflow.llm.common import fold, table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


@query
def op1_maxscore(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five best other vectors, by integer inner product, of every fiftieth vector."""
    rows = table(spark, sf_dir, "embeddings").where(hard_negatives.is_whole(F.col("embedding")))
    vectors = rows.select("vec_id", hard_negatives.whole_components(F.col("embedding")).alias("v"))
    found = maxscore.top_k_rows(vectors, F.col("vec_id") % 50 == 0, k=5)
    return found.select("query_id", "rank", "vec_id", F.col("score").cast("long").alias("score"))


@query
def op2_sampled_splitters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents over 16 shards of equal bytes."""
    placed = splitters.shard_documents(table(spark, sf_dir, "documents"), shards=16)
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


#: target shares of tokens: prose, toxic, poor
MIX_TARGETS = [0.93, 0.01, 0.06]


@query
def op3_soft_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Domain memberships of every document and the rate that mixes all to the targets."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labelled = table(spark, sf_dir, "labels").select("doc_id", mixing.domain_of_labels().alias("label"))
    rated, _ = mixing.rates(docs, labelled, MIX_TARGETS)
    named = [F.col(f"p{d}").alias(f"p_{name}") for d, name in enumerate(mixing.DOMAINS)]
    return rated.select("doc_id", "tokens", *named, "rate", "copies")


@query
def op4_ordinal_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Expected grade and tail probabilities of every document."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    rated = labels.where("quality is not null").select("doc_id", ordinal.grades_of_labels().alias("label"))
    model = ordinal.fit(docs, rated, grades=3)
    return ordinal.grade(docs, model).select(
        "doc_id",
        "expected_grade",
        F.get("tails", F.lit(0)).alias("p_at_least_1"),
        F.get("tails", F.lit(1)).alias("p_at_least_2"),
        "kept",
    )


@query
def op5_deobfuscated_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The toxicity of every document; labels of a third of the ids are held out."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = deobfuscation.fit(docs, table(spark, sf_dir, "labels"), folds=3, held_out=1)
    scored = deobfuscation.score(docs, model)
    return scored.select(
        "doc_id",
        (fold(F.col("doc_id"), 3) == 1).alias("held_out"),
        F.col("toxicity").alias("score"),
        (F.col("toxicity") >= deobfuscation.THRESHOLD).cast("int").alias("predicted"),
    )


@query
def op6_lyndon_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the strings of 200 bytes that occur more than once."""
    left = lyndon_suffixes.remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return left.select(
        "doc_id",
        "n_bytes",
        "n_removed",
        F.size("removed").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


@query
def op7_hidden_markov(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log10 probabilities of every document; a fifth of the ids is held out."""
    return hidden_markov.score(table(spark, sf_dir, "documents").select("doc_id", "text"), folds=5, held_out=1)


@query
def op8_warc_normaliser(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages through monolithic archives, their normalised form, and back."""
    return warc.archive_pages(table(spark, sf_dir, "pages"), least_bytes=0).drop("url", "payload")


@query
def op10_tensor_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate classes of all documents on two-word shingles."""
    classes, _ = tensor_minhash.near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"), size=2)
    # a class without any id has none to keep it by: its rows stay
    kept = F.coalesce(F.col("doc_id") == F.col("component_id"), F.col("component_id").isNull())
    return classes.select("doc_id", "n_shingles", "component_id", kept.alias("kept"))


@query
def op11_segment_summaries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every hundredth vector; every seventh label is moved on by one first."""
    rows = table(spark, sf_dir, "embeddings").where(hard_negatives.is_whole(F.col("embedding")))
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")).cast("int")
    vectors = rows.select("vec_id", label.alias("label"), hard_negatives.whole_components(F.col("embedding")).alias("v"))
    return hard_negatives.mine(vectors, F.col("vec_id") % 100 == 0)


@query
def op12_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gains towards the benchmark's n-grams of every document, and the drawn quarter."""
    scored = resampling.resample(
        table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark")
    )
    return scored.select("doc_id", "n_features", "weight", "score", "rank")


@query
def op13_relative_lempel_ziv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the passages of 50 words that earlier documents hold."""
    left = lempel_ziv.remove_passages(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return left.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


# the remainders of single bytes by which CRC-32 advances, and the CRC of a text's bytes
CRC_STEPS = """
  SELECT list(list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0],
         lambda c, x: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY i) AS steps
  FROM (SELECT range AS i FROM range(256))
"""
CRC = """
  xor(list_reduce(list_prepend(4294967295,
      list_transform(regexp_extract_all(hex(encode({text})), '..'), lambda h: ('0x' || h)::BIGINT)),
      lambda a, b: xor(a >> 8, steps[(xor(a, b) & 255) + 1])), 4294967295)
"""

ORACLES["op2_sampled_splitters"] = f"""
WITH crc_steps AS ({CRC_STEPS}),
sized AS (
  SELECT doc_id, (strlen(coalesce(text, '')) + 1)::BIGINT AS size,
         ({CRC.format(text="coalesce(text, '')")})::BIGINT AS text_crc32
  FROM documents, crc_steps
),
placed AS (
  SELECT *, ((sum(size) OVER (ORDER BY doc_id NULLS FIRST ROWS UNBOUNDED PRECEDING) - size) * 16
             // sum(size) OVER ())::INTEGER AS shard
  FROM sized
)
SELECT doc_id, size, text_crc32, 'bytes' AS law, shard,
       (row_number() OVER (PARTITION BY shard ORDER BY doc_id NULLS FIRST) - 1)::BIGINT AS slot,
       NULL::INTEGER AS grown_shard
FROM placed
"""


@query
def op9_spaced_seeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every overlap of a document with a benchmark item."""
    return spaced_seeds.contaminations(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), least_tokens=1)


ORACLES["op9_spaced_seeds"] = r"""
WITH doc_words AS (
  SELECT doc_id, list_filter(string_split_regex(lower(text), '[^\p{L}\p{M}\p{N}]+'), lambda w: w <> '') AS ws FROM documents
),
item_words AS (
  SELECT item_id, list_filter(string_split_regex(lower(text), '[^\p{L}\p{M}\p{N}]+'), lambda w: w <> '') AS ws FROM benchmark
),
d AS (SELECT doc_id, len(ws) AS n, unnest(ws) AS w, generate_subscripts(ws, 1) - 1 AS p FROM doc_words),
i AS (
  SELECT item_id, len(ws) AS l, unnest(ws) AS w, generate_subscripts(ws, 1) - 1 AS q
  FROM item_words WHERE len(ws) >= 1
),
same AS (
  SELECT doc_id, item_id, l, n, p - q AS shift, list(q ORDER BY q) AS qs
  FROM d JOIN i USING (w) GROUP BY ALL HAVING count(*) >= least(l, 11)
),
starts AS (SELECT *, unnest(range(greatest(0, -shift), least(l, n - shift) - 12)) AS s FROM same WHERE l >= 13),
overlapping AS (
  SELECT DISTINCT doc_id, item_id, l, shift, len(qs) AS matched FROM starts
  WHERE len(list_filter(qs, lambda x: x BETWEEN s AND s + 12)) >= 11
  UNION ALL
  SELECT doc_id, item_id, l, shift, len(qs) FROM same WHERE l < 13 AND len(qs) = l
)
SELECT doc_id, item_id, max(matched)::INTEGER AS matched, first(l ORDER BY matched DESC, shift)::INTEGER AS item_tokens,
       first(shift ORDER BY matched DESC, shift)::INTEGER AS at_token
FROM overlapping GROUP BY doc_id, item_id
"""

# SHA-1 is in DuckDB; base 32 is taken from the digest's 160 bits, five at a time
ORACLES["op8_warc_normaliser"] = """
WITH hashed AS (
  SELECT page_id, encode(coalesce(html, '')) AS payload, sha1(encode(coalesce(html, ''))) AS hex FROM pages
),
bits AS (
  SELECT *, list_aggregate(list_transform(string_split(hex, ''),
              lambda h: lpad(bin(strpos('0123456789abcdef', h) - 1), 4, '0')), 'string_agg', '') AS b FROM hashed
),
coded AS (
  SELECT page_id, payload, list_aggregate(list_transform(range(32),
           lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
             1 + list_sum(list_transform(range(5), lambda k: (substr(b, 5 * i + k + 1, 1)::INT) * (16 >> k)))::INT, 1)),
           'string_agg', '') AS digest FROM bits
)
SELECT page_id, octet_length(payload)::BIGINT AS payload_bytes, digest AS payload_digest,
       CASE WHEN page_id = max(page_id) OVER same THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> max(page_id) OVER same THEN max(page_id) OVER same END AS refers_to
FROM coded WINDOW same AS (PARTITION BY payload)
"""

ORACLES["op10_tensor_minhash"] = r"""
WITH RECURSIVE tokens AS (
  SELECT doc_id, list_filter(string_split_regex(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w
  FROM documents
),
sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) = 1 THEN [w[1]]
           ELSE list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) END AS s
  FROM tokens
),
sizes AS (SELECT doc_id, len(s) AS n FROM sets),
shingles AS (SELECT doc_id, unnest(s) AS x FROM sets),
links AS (
  SELECT a.doc_id AS a, b.doc_id AS b
  FROM shingles a JOIN shingles b ON a.x = b.x AND a.doc_id <> b.doc_id
  JOIN sizes p ON p.doc_id = a.doc_id JOIN sizes q ON q.doc_id = b.doc_id
  GROUP BY a.doc_id, b.doc_id, p.n, q.n
  HAVING 100 * count(*) >= 80 * (p.n + q.n - count(*))
),
reach AS (
  SELECT doc_id, doc_id AS root FROM sizes
  UNION
  SELECT l.b, r.root FROM reach r JOIN links l ON l.a = r.doc_id
)
SELECT doc_id, n::BIGINT AS n_shingles, min(root) AS component_id, doc_id = min(root) AS kept
FROM reach JOIN sizes USING (doc_id) GROUP BY doc_id, n
"""

ORACLES["op1_maxscore"] = """
WITH vectors AS (
  SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
scored AS (
  SELECT q.r, q.vec_id AS query_id, d.vec_id, list_inner_product(q.v, d.v)::BIGINT AS score
  FROM vectors q JOIN vectors d ON q.vec_id % 50 = 0 AND d.r <> q.r
)
SELECT query_id, (row_number() OVER best)::INTEGER AS rank, vec_id, score FROM scored
WINDOW best AS (PARTITION BY r ORDER BY score DESC, vec_id NULLS LAST)
QUALIFY row_number() OVER best <= 5
"""

ORACLES["op12_importance_resampling"] = rf"""
WITH crc_steps AS ({CRC_STEPS}),
texts AS (SELECT doc_id, text, true AS own FROM documents UNION ALL SELECT NULL, text, false FROM benchmark),
tokens AS (
  SELECT row_number() OVER () AS r, doc_id, own, regexp_extract_all(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM texts
),
grams AS (
  SELECT r, own, unnest(w || list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) AS g FROM tokens
),
counted AS (SELECT r, own, g, count(*) AS n FROM grams GROUP BY ALL),
kinds AS (
  SELECT g, ({CRC.format(text="g")}) % 10000 AS b FROM (SELECT DISTINCT g FROM counted), crc_steps
),
held AS (
  SELECT b, coalesce(sum(n) FILTER (own), 0)::DOUBLE AS s, coalesce(sum(n) FILTER (NOT own), 0)::DOUBLE AS t
  FROM counted JOIN kinds USING (g) GROUP BY b
),
gains AS (
  SELECT b, floor(1000 * ln((t + 1) * ((SELECT sum(t) FROM held) + 10000)
                            / ((s + 1) * ((SELECT sum(s) FROM held) + 10000))))::BIGINT AS gain FROM held
),
sums AS (
  SELECT r, sum(n)::BIGINT AS n, sum(n * gain)::BIGINT AS total
  FROM counted JOIN kinds USING (g) JOIN gains USING (b) GROUP BY r
),
weighed AS (
  SELECT doc_id, len(w) AS words, coalesce(n, 0)::BIGINT AS n_features,
         coalesce((total - ((total % n) + n) % n) // n, 0)::BIGINT AS weight,
         ('0x' || substr(sha256('7:' || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT AS h
  FROM tokens LEFT JOIN sums USING (r) WHERE own
),
scored AS (SELECT *, (weight + floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296::DOUBLE))))::BIGINT AS score FROM weighed),
ranks AS (
  SELECT *, CASE WHEN words >= 20 THEN row_number() OVER (PARTITION BY words >= 20 ORDER BY score DESC, doc_id) END AS place FROM scored
)
SELECT doc_id, n_features, weight, score,
       CASE WHEN place <= 25 * (SELECT count(*) FROM scored WHERE words >= 20) // 100 THEN place END::BIGINT AS rank
FROM ranks
"""

ORACLES["op11_segment_summaries"] = """
WITH vectors AS (
  SELECT row_number() OVER () AS r, vec_id, (CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END)::INTEGER AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
scored AS (
  SELECT a.r AS anchor, a.vec_id AS anchor_id, b.r, b.vec_id, a.label = b.label AS same,
         list_inner_product(a.v, b.v)::BIGINT AS score
  FROM vectors a JOIN vectors b ON a.vec_id % 100 = 0 AND a.r <> b.r
),
positives AS (
  SELECT * FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor ORDER BY score DESC, vec_id NULLS LAST, r) <= 5
),
pairs AS (
  SELECT p.anchor, p.r, p.anchor_id, p.vec_id AS positive_id, n.vec_id AS negative_id,
         p.score AS positive_score, n.score AS negative_score,
         row_number() OVER (PARTITION BY p.anchor, p.r ORDER BY n.score DESC, n.vec_id NULLS LAST, n.r) AS rank
  FROM positives p JOIN scored n ON n.anchor = p.anchor AND NOT n.same
   AND 30 * p.score <= 100 * n.score AND 100 * n.score <= 90 * p.score
)
SELECT anchor_id, positive_id, rank::INTEGER AS rank, negative_id, positive_score, negative_score FROM pairs WHERE rank <= 10
"""

ORACLES["op13_relative_lempel_ziv"] = r"""
WITH tokens AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
),
starts AS (SELECT r, doc_id, w, unnest(range(1, len(w) - 48)) AS s FROM tokens),
windows AS (SELECT r, doc_id, s, md5(array_to_string(w[s:s + 49], ' ')) AS k FROM starts),
firsts AS (SELECT k, min(doc_id) AS first FROM windows GROUP BY k),
gone AS (
  SELECT DISTINCT r, unnest(range(s, s + 50)) AS p FROM windows JOIN firsts USING (k) WHERE first < doc_id
),
words AS (SELECT r, unnest(w) AS word, generate_subscripts(w, 1) AS p FROM tokens),
kept AS (
  SELECT r, string_agg(word, ' ' ORDER BY p) FILTER (gone.r IS NULL) AS text, count(gone.r) AS n
  FROM words LEFT JOIN gone USING (r, p) GROUP BY r
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n, 0)::BIGINT AS n_removed, sha256(coalesce(kept.text, '')) AS kept_sha256
FROM tokens LEFT JOIN kept USING (r)
"""
