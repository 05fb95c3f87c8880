"""Importance resampling towards a target: hashed n-gram features, log-ratio gains, a Gumbel top-k draw.

The n-grams of a batch are interned in an open-addressed table of NumPy arrays, keyed by
xxhash64 and verified by their bytes. A slot stores the bucket and the count of its
n-gram; the slot ids of the occurrences gather what the documents need.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketflow.llm.spans import ALNUM, LOWER, flat, lanes, row_slices, word_spans
from marketflow.session import settle

BUCKETS, ORDER = 10_000, 2
#: words whose n-grams are interned in one table
TABLE_WORDS = 200_000

# fixed values: the five primes of XXH64
_P1, _P2, _P3, _P4, _P5 = (
    np.uint64(p)
    for p in (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5)
)


def _turned(x: np.ndarray, by: int) -> np.ndarray:
    return (x << np.uint64(by)) | (x >> np.uint64(64 - by))


def xxhash64(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """XXH64, seed 0, of each span of `data` (which ends in seven spare bytes).

    Spans of one length go through the same steps, so each length is one vector
    computation; spans of 32 bytes and more are hashed one by one.
    """
    found = np.empty(len(starts), np.uint64)
    eight = lanes(data)
    order = np.argsort(lengths.astype(np.uint16) if lengths.max(initial=0) < 65536 else lengths, kind="stable")
    sizes = lengths[order]
    cuts = np.flatnonzero(np.diff(sizes)) + 1
    for some in np.split(order, cuts) if len(order) else ():
        size, at = int(lengths[some[0]]), starts[some]
        if size >= 32:
            found[some] = [xxhash.xxh64_intdigest(data[a : a + size].tobytes()) for a in at.tolist()]
            continue
        h, done = np.full(len(some), _P5 + np.uint64(size), np.uint64), 0
        while size - done >= 8:
            h = _turned(h ^ (_turned(eight[at + done] * _P2, 31) * _P1), 27) * _P1 + _P4
            done += 8
        if size - done >= 4:
            h = _turned(h ^ ((eight[at + done] & np.uint64(0xFFFFFFFF)) * _P1), 23) * _P2 + _P3
            done += 4
        for k in range(done, size):
            h = _turned(h ^ (data[at + k].astype(np.uint64) * _P5), 11) * _P1
        h = (h ^ (h >> np.uint64(33))) * _P2
        h = (h ^ (h >> np.uint64(29))) * _P3
        found[some] = h ^ (h >> np.uint64(32))
    return found


def same_bytes(data: np.ndarray, a: np.ndarray, b: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Whether the spans at `a` and at `b` hold the same bytes (`data` ends in seven spare bytes)."""
    eight, same = lanes(data), np.ones(len(a), bool)
    left = np.arange(len(a))
    done = 0
    while len(left):
        rest = lengths[left] - done
        # of a last lane only the bytes inside the span count
        spare = np.uint64(8) * np.clip(8 - rest, 0, 7).astype(np.uint64)
        differ = ((eight[a[left] + done] ^ eight[b[left] + done]) << spare) != 0
        same[left[differ]] = False
        left = left[~differ & (rest > 8)]
        done += 8
    return same


class Interned:
    """An open-addressed table of the n-grams of some spans.

    `slot_of`: the slot of each occurrence. `bucket`, `count`: of each slot. `owner`: the
    occurrence whose bytes stand for the slot, -1 if it is free. Occurrences probe from
    the slot of their hash on. A free slot is taken by one of those that meet there; the
    others, like all that find a taken slot, compare hash, length and bytes with its
    owner and move on if they differ.
    """

    def __init__(self, data: np.ndarray, starts: np.ndarray, lengths: np.ndarray, hashes: np.ndarray | None = None):
        n = len(starts)
        size = 1 << max(4, (2 * n - 1).bit_length())
        keys = xxhash64(data, starts, lengths) if hashes is None else hashes
        self.owner = np.full(size, -1, np.int32)
        self.slot_of = np.empty(n, np.int32)
        at = (keys & np.uint64(size - 1)).astype(np.int64)
        left = np.arange(n, dtype=np.int32)
        while len(left):
            here = at[left]
            free = self.owner[here] < 0
            self.owner[here[free]] = left[free]
            owner = self.owner[here]
            same = (keys[owner] == keys[left]) & (lengths[owner] == lengths[left])
            again = np.flatnonzero(same & (owner != left))
            same[again] = same_bytes(data, starts[owner[again]], starts[left[again]], lengths[left[again]])
            self.slot_of[left[same]] = here[same]
            left = left[~same]
            at[left] = (at[left] + 1) & (size - 1)
        self.count = np.bincount(self.slot_of, minlength=size)
        self.bucket = np.full(size, -1, np.int32)

    def taken(self) -> np.ndarray:
        return np.flatnonzero(self.owner >= 0)


#: CRC-32 of a text continued by `size` bytes is linear in the CRC so far: four tables of 256 entries a size
_CONTINUED: dict[int, np.ndarray] = {}
_SIZES_KEPT = 64


def _continued(size: int) -> np.ndarray:
    tables = _CONTINUED.get(size)
    if tables is None:
        zeros = bytes(size)
        none = zlib.crc32(zeros)
        tables = np.array([[zlib.crc32(zeros, b << (8 * k)) ^ none for b in range(256)] for k in range(4)], np.uint32)
        if size <= _SIZES_KEPT:
            _CONTINUED[size] = tables
    return tables


def crc_joined(left: np.ndarray, right: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """CRC-32 of texts that end in parts of `sizes` bytes, from the CRCs of both parts."""
    made = np.empty(len(left), np.uint32)
    order = np.argsort(sizes, kind="stable")
    for some in np.split(order, np.flatnonzero(np.diff(sizes[order])) + 1) if len(order) else ():
        tables, crc = _continued(int(sizes[some[0]])), left[some]
        moved = tables[0][crc & 255] ^ tables[1][(crc >> 8) & 255] ^ tables[2][(crc >> 16) & 255] ^ tables[3][crc >> 24]
        made[some] = moved ^ right[some]
    return made


def _spaced(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(the words, each followed by one space, and seven spare bytes; the start of each word)."""
    sizes = ends - starts
    at = np.cumsum(sizes + 1) - sizes - 1
    made = np.full(int(sizes.sum()) + len(sizes) + 8, 32, np.uint8)
    shift = np.repeat(at - starts, sizes)
    within = np.arange(len(shift)) - np.repeat(np.cumsum(sizes) - sizes, sizes) + np.repeat(starts, sizes)
    made[within + shift] = data[within]
    return made, at


def bucketed(data: np.ndarray, offsets: np.ndarray, buckets: int, order: int, counts: np.ndarray) -> tuple[np.ndarray, ...]:
    """(words of each row, rows and buckets of all n-gram occurrences, in the order of rows).

    Adds the n-grams' counts to `counts`.
    """
    starts, ends, rows = word_spans(data, offsets, ALNUM)
    found_rows, found_buckets = [np.empty(0, np.int64)], [np.empty(0, np.uint16)]
    for first in range(0, len(starts), TABLE_WORDS):
        # the words of this table begin the n-grams, the next ones may end them
        last = min(first + TABLE_WORDS, len(starts))
        more = min(last + order - 1, len(starts))
        joined, at = _spaced(data, starts[first:more], ends[first:more])
        sizes, row = (ends - starts)[first:more], rows[first:more]
        n = last - first
        words = Interned(joined, at[:], sizes[:])
        taken = words.taken()
        owner = words.owner[taken]
        crc = np.zeros(len(words.owner), np.uint32)
        crc[taken] = [zlib.crc32(joined[a : a + s].tobytes()) for a, s in zip(at[owner].tolist(), sizes[owner].tolist())]
        of_word, space = crc[words.slot_of], np.full(more - first, zlib.crc32(b" "), np.uint32)
        so_far, length = of_word.copy(), sizes.copy()
        for size in range(1, order + 1):
            begin = np.arange(max(0, min(n, more - first - size + 1)))
            begin = begin[row[begin] == row[begin + size - 1]]
            if size > 1:
                end = begin + size - 1
                so_far[begin] = crc_joined(crc_joined(so_far[begin], space[begin], np.ones(len(begin), np.int64)), of_word[end], sizes[end])
                length[begin] += 1 + sizes[end]
            table = Interned(joined, at[begin], length[begin])
            taken = table.taken()
            table.bucket[taken] = so_far[begin[table.owner[taken]]] % np.uint32(buckets)
            np.add.at(counts, table.bucket[taken], table.count[taken])
            found_rows.append(row[begin])
            found_buckets.append(table.bucket[table.slot_of].astype(np.uint16))
    row, bucket = np.concatenate(found_rows), np.concatenate(found_buckets)
    by_row = np.argsort(row, kind="stable")
    return np.bincount(rows, minlength=len(offsets) - 1), row[by_row], bucket[by_row]


_FEATURES = "doc_id long, row long, n_words long, n_features long, buckets binary, counts array<long>"


def features(docs: DataFrame, buckets: int = BUCKETS, order: int = ORDER) -> DataFrame:
    """The bucket of every n-gram occurrence of each text, and per task what the buckets hold.

    Rows of `docs` (doc_id, row, text) have `counts` null and `buckets` as 16-bit numbers;
    each task adds one row with null `buckets` and the sums of its `counts`.
    """
    if buckets > 1 << 16:
        raise ValueError("at most 65536 buckets")
    schema = pa.schema(
        [("doc_id", pa.int64()), ("row", pa.int64()), ("n_words", pa.int64()), ("n_features", pa.int64()), ("buckets", pa.binary()), ("counts", pa.list_(pa.int64()))]
    )

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(buckets, np.int64)
        for batch in batches:
            data, offsets = flat(batch.column("text"))
            for first, last in row_slices(offsets):
                here = offsets[first : last + 1] - offsets[first]
                words, row, bucket = bucketed(LOWER[data[offsets[first] : offsets[last]]], here, buckets, order, counts)
                n = np.bincount(row, minlength=last - first)
                held = pa.LargeBinaryArray.from_buffers(
                    pa.large_binary(), last - first, [None, pa.py_buffer(2 * np.concatenate([[0], np.cumsum(n)])), pa.py_buffer(np.ascontiguousarray(bucket))]
                )
                columns = [batch.column(c).slice(first, last - first).cast(pa.int64()) for c in ("doc_id", "row")]
                columns += [pa.array(words), pa.array(n), held.cast(pa.binary()), pa.nulls(last - first, pa.list_(pa.int64()))]
                yield pa.RecordBatch.from_arrays(columns, schema=schema)
        total = [pa.nulls(1, f.type) for f in schema][:-1] + [pa.array([counts], pa.list_(pa.int64()))]
        yield pa.RecordBatch.from_arrays(total, schema=schema)

    given = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "row", F.col("text").cast("binary").alias("text"))
    return given.mapInArrow(made, _FEATURES)


def _held(found: DataFrame, buckets: int) -> np.ndarray:
    """The counts of all tasks by bucket: summed on the executors, `buckets` numbers in all."""
    parts = found.where("counts is not null").select(F.posexplode("counts").alias("bucket", "n")).where("n > 0")
    total = np.zeros(buckets, np.int64)
    for bucket, n in parts.groupBy("bucket").agg(F.sum("n")).collect():
        total[bucket] = n
    return total


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 * log of the ratio of smoothed shares) of each bucket, in doubles."""
    n = float(len(source))
    ratio = (target + 1.0) * (float(source.sum()) + n) / ((source + 1.0) * (float(target.sum()) + n))
    return np.floor(1000 * np.log(ratio)).astype(np.int64)


def _weights(found: DataFrame, gain: np.ndarray) -> DataFrame:
    """Floored mean of the gains of each text's occurrences."""

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = flat(batch.column("buckets"))
            sums = []
            for first, last in row_slices(offsets):
                got = gain[np.frombuffer(data[offsets[first] : offsets[last]], np.uint16)]
                total = np.concatenate([[0], np.cumsum(got)])
                at = (offsets[first : last + 1] - offsets[first]) // 2
                sums.append(total[at[1:]] - total[at[:-1]])
            n = np.diff(offsets) // 2
            weight = np.concatenate([np.empty(0, np.int64), *sums]) // np.maximum(n, 1)
            kept = [batch.column(c) for c in ("doc_id", "row", "n_words", "n_features")]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(weight, pa.int64())], names=["doc_id", "row", "n_words", "n_features", "weight"])

    rows = found.where("counts is null").select("doc_id", "row", "n_words", "n_features", "buckets")
    return rows.mapInArrow(weigh, "doc_id long, row long, n_words long, n_features long, weight long")


def ranked(rows: DataFrame, order: list, label: str = "ranked") -> DataFrame:
    """`rows` with `rank`, 1 for the first by `order`: a range partitioning, sorted, plus the sizes of the ranges before.

    No task holds more than its range; the sizes are one row a range.
    """
    within = (1 << 33) - 1
    placed = rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("rank", F.monotonically_increasing_id())
    placed = settle(placed, label)
    part = F.shiftright("rank", 33)
    sizes = sorted(map(tuple, placed.groupBy(part.alias("part")).count().collect()))
    before, total = {}, 0
    for number, n in sizes:
        before[number], total = total, total + n
    offsets = rows.sparkSession.createDataFrame(list(before.items()) or [(0, 0)], "part long, before long")
    return placed.withColumn("part", part).join(F.broadcast(offsets), "part").withColumn(
        "rank", F.col("before") + F.col("rank").bitwiseAND(within) + 1
    ).drop("part", "before")


def resample(
    docs: DataFrame, target: DataFrame, percent: int = 25, least_words: int = 20, seed: int = 7, buckets: int = BUCKETS, order: int = ORDER
) -> DataFrame:
    """doc_id, row, n_words, n_features, weight, score and rank of every row of `docs` (doc_id, text; `row` if it has one).

    Texts are lower-cased (A-Z); words are runs of digits, letters a-z and anything beyond
    ASCII; the features are all runs of 1 to `order` words joined by one space, hashed by
    CRC-32 into buckets. A bucket's gain compares its share in `target` (text) with that
    in all of `docs`; `weight` is a text's floored mean gain, 0 without features. The
    score adds Gumbel noise from the id, so that the `percent` % of the texts of
    `least_words` words or more with the highest scores are a draw without replacement
    with chances in proportion to exp(weight / 1000). They are ranked from 1; the others
    have null ranks.

    Null texts are empty. A null doc_id gives the noise of an empty id and comes last among ties.
    Repeated rows are rows of their own. An empty table gives no rows; an empty target
    gives every bucket a share of one over their number.
    """
    if "row" not in docs.columns:
        docs = docs.select("doc_id", "text", F.monotonically_increasing_id().alias("row"))
    found = settle(features(docs, buckets, order), "features")
    wanted = features(target.select(F.lit(0).alias("doc_id"), F.lit(0).cast("long").alias("row"), "text"), buckets, order)
    gain = gains(_held(found, buckets), _held(wanted, buckets))
    number = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256), 1, 8), 16, 10)
    noise = F.floor(-1000 * F.log(-F.log((number.cast("double") + 0.5) / 4294967296.0)))
    scored = settle(_weights(found, gain).withColumn("score", (F.col("weight") + noise).cast("long")), "scored")
    enough = F.col("n_words") >= least_words
    drawn = percent * scored.where(enough).count() // 100
    by = [F.desc("score"), F.asc_nulls_last("doc_id"), F.asc("n_features"), F.asc("row")]
    placed = ranked(scored.where(enough), by).withColumn("rank", F.when(F.col("rank") <= drawn, F.col("rank")))
    return placed.unionByName(scored.where(~enough).withColumn("rank", F.lit(None).cast("long")))


def draw(docs: DataFrame, target: DataFrame, percent: int = 25, **settings: int) -> DataFrame:
    """The drawn rows of `docs`, with all their columns as they are; see `resample`."""
    names = docs.columns
    plain = docs.toDF(*[f"c{i}" for i in range(len(names))])
    numbered = settle(plain.withColumn("row", F.monotonically_increasing_id()), "numbered")
    column = {name: f"c{i}" for i, name in enumerate(names)}
    given = numbered.select(F.col(column["doc_id"]).alias("doc_id"), F.col(column["text"]).alias("text"), "row")
    drawn = resample(given, target, percent, **settings).where("rank is not null").select("row")
    return numbered.join(drawn, "row").drop("row").toDF(*names)
