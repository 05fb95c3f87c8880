"""Substring dedup by relative Lempel-Ziv parsing: repeated passages as long factors of earlier documents.

Equal windows of `WINDOW` words are brought together by an anchor, the least hashed
`ANCHOR` words inside the window, which equal windows share. The passages around anchors
that several documents hold are dealt to reference blocks by anchor. In a block the
passages are indexed by a suffix array, and each is factored greedily into longest
matches with passages of earlier documents. A factor of a window's length or more is
repeated text; at the boundary of two factors that are together longer than a window,
the windows across it are checked.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketflow.llm.spans import NOT_BLANK, flat, row_slices, word_spans
from marketflow.session import settle

#: words of a repeated passage, and of the runs among which its anchor is chosen
WINDOW, ANCHOR = 50, 25
#: window starts that a long text is cut into at a time
BLOCK = 1 << 20
#: passages of a reference block, and different passages around one anchor before it is split by its context
BLOCK_PASSAGES, MOST_PASSAGES = 8192, 1024

_RANDOM = np.random.default_rng(11)
_BYTES = _RANDOM.integers(0, 2**63, 256, dtype=np.uint64)
_BASE, _UNBASE = 0x9E3779B97F4A7C15, pow(0x9E3779B97F4A7C15, -1, 2**64)
_SALT = np.uint64(0x5851F42D4C957F2D)


def mixed(values: np.ndarray) -> np.ndarray:
    """Bits spread over the whole number."""
    values = (values ^ (values >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    values = (values ^ (values >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return values ^ (values >> np.uint64(32))


class Rolling:
    """Hashes of any spans of a sequence, from prefix sums of its values times powers of a base."""

    _up = _down = np.ones(1, np.uint64)

    def __init__(self, values: np.ndarray):
        n = len(values) + 1
        if len(Rolling._up) < n:
            size = max(n, 1 << 16)
            Rolling._up, Rolling._down = (
                np.concatenate([[np.uint64(1)], np.cumprod(np.full(size, base, np.uint64))]) for base in (_BASE, _UNBASE)
            )
        self.total = np.concatenate([[np.uint64(0)], np.cumsum(values * Rolling._up[: n - 1])])
        self.down = Rolling._down

    def spans(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mixed((self.total[ends] - self.total[starts]) * self.down[starts])


def hashed_words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(64-bit hash of each word, first word of each row and the end)."""
    starts, ends, rows = word_spans(data, offsets, NOT_BLANK)
    hashes = Rolling(_BYTES[data]).spans(starts, ends) + _SALT * (ends - starts).astype(np.uint64)
    return hashes, np.searchsorted(rows, np.arange(len(offsets)))


def least_of(values: np.ndarray, width: int) -> np.ndarray:
    """Index of the least of each `width` neighbours, the first of equal ones."""
    n = len(values)
    order = np.argsort(values, kind="stable")
    rank = np.empty(n, np.int64)
    rank[order] = np.arange(n)
    rows = -(-n // width)
    padded = np.full(rows * width, n, np.int64)
    padded[:n] = rank
    square = padded.reshape(rows, width)
    head = np.minimum.accumulate(square, 1).ravel()
    tail = np.minimum.accumulate(square[:, ::-1], 1)[:, ::-1].ravel()
    windows = n - width + 1
    return order[np.minimum(tail[:windows], head[width - 1 : width - 1 + windows])]


def runs(words: np.ndarray, window: int = WINDOW, anchor: int = ANCHOR) -> tuple[np.ndarray, ...]:
    """The runs of window starts that share an anchor: (anchor hash, passage hash, first, last, anchor's place).

    The passage of a run is all that its windows cover.
    """
    found = []
    for at in range(0, len(words) - window + 1, BLOCK):
        part = words[at : at + BLOCK + window - 1]
        rolling = Rolling(part)
        begin = np.arange(len(part) - anchor + 1)
        hashes = rolling.spans(begin, begin + anchor)
        place = least_of(hashes, window - anchor + 1)
        first = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1]]))
        last = np.append(first[1:], len(place)) - 1
        passage = rolling.spans(first, last + window) + _SALT * (last - first).astype(np.uint64)
        found.append((hashes[place[first]], passage, first + at, last + at, place[first] + at))
    if not found:
        none = np.empty(0, np.int64)
        return none.astype(np.uint64), none.astype(np.uint64), none, none, none
    return tuple(map(np.concatenate, zip(*found)))


_RUNS = "anchor long, passage long, doc long, row long, first int, last int, place int"


def _runs_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["anchor", "passage", "doc", "row", "first", "last", "place"]
    for batch in batches:
        data, offsets = flat(batch.column("text"))
        docs, numbers = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("doc", "row"))
        for a, b in row_slices(offsets):
            words, begins = hashed_words(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
            made = []
            for k in range(b - a):
                if begins[k + 1] - begins[k] >= WINDOW:
                    anchor, passage, first, last, place = runs(words[begins[k] : begins[k + 1]])
                    made.append((anchor.view(np.int64), passage.view(np.int64), np.full(len(first), docs[a + k]), np.full(len(first), numbers[a + k]), first, last, place))
            if made:
                columns = list(map(np.concatenate, zip(*made)))
                arrays = [pa.array(c, pa.int64()) for c in columns[:4]] + [pa.array(c, pa.int32()) for c in columns[4:]]
                yield pa.RecordBatch.from_arrays(arrays, names=names)


# ---- a reference block: suffix array, earlier matches, greedy factors


def next_smaller(values: np.ndarray) -> np.ndarray:
    """For each place the nearest one after it with a smaller value; the length if there is none.

    Descends from the minima of long stretches to those of short ones.
    """
    n = len(values)
    minima = [values]
    while 2 << (len(minima) - 1) <= n:
        last, half = minima[-1], 1 << (len(minima) - 1)
        minima.append(np.minimum(last[:-half], last[half:]))
    at = np.arange(1, n + 1)
    for k in range(len(minima) - 1, -1, -1):
        fits = np.flatnonzero(at + (1 << k) <= n)
        on = fits[minima[k][at[fits]] >= values[fits]]
        at[on] += 1 << k
    return at


class Reference:
    """The passages of a block, in the order of documents, indexed by a suffix array.

    `longest(p)` is the length of the longest match of the text at `p` with a passage of
    an earlier document; matches end with their passages.
    """

    def __init__(self, passages: list[np.ndarray], docs: np.ndarray):
        """`docs` must rise."""
        sizes = np.array([len(p) for p in passages])
        self.starts = np.cumsum(sizes + 1) - sizes - 1
        n = int(sizes.sum()) + len(sizes)
        words = np.empty(n, np.int64)
        inside = np.ones(n, bool)
        inside[self.starts + sizes] = False
        values, words_of = np.unique(np.concatenate(passages), return_inverse=True)
        words[inside] = words_of + len(sizes)
        words[~inside] = np.arange(len(sizes))  # every end differs from all else
        doc = np.repeat(docs, sizes + 1)
        # ranks of the first 1, 2, 4, ... words of each suffix
        self.ranks, rank, step = [], np.unique(words, return_inverse=True)[1], 1
        while True:
            self.ranks.append(rank)
            if int(rank.max()) == n - 1:
                break
            after = np.zeros(n, np.int64)
            after[: n - step] = rank[step:] + 1
            rank = np.unique(rank * (n + 1) + after, return_inverse=True)[1]
            step *= 2
        order = np.argsort(rank)
        # nearest neighbours in the order of suffixes that belong to an earlier document
        by_order = np.unique(doc[order], return_inverse=True)[1].astype(np.int32)
        self.neighbours = []
        for turned in (False, True):
            near = next_smaller(by_order[::-1] if turned else by_order)
            if turned:
                near = np.where(near[::-1] < n, n - 1 - near[::-1], n)
            at = np.full(n, -1)
            at[order] = np.where(near < n, order[np.minimum(near, n - 1)], -1)
            self.neighbours.append(at)
        self.ends = self.starts + sizes

    def longest(self, places: np.ndarray) -> np.ndarray:
        """Words that the text at each place shares with the best earlier one."""
        best = np.zeros(len(places), np.int64)
        for at in self.neighbours:
            a, b = places.copy(), at[places]
            some = np.flatnonzero(b >= 0)
            a, b, length = a[some], b[some], np.zeros(len(some), np.int64)
            for k in range(len(self.ranks) - 1, -1, -1):
                rank = self.ranks[k]
                same = rank[np.minimum(a, len(rank) - 1)] == rank[np.minimum(b, len(rank) - 1)]
                same &= (a < len(rank)) & (b < len(rank))
                a, b, length = a + (same << k), b + (same << k), length + (same << k)
            best[some] = np.maximum(best[some], length)
        return best

    def factors(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(passage, start, length) of the greedy factors of all passages; a word that no earlier one has is a factor of 0."""
        found = []
        at, left = self.starts.copy(), np.arange(len(self.starts))
        while len(left):
            length = self.longest(at[left])
            found.append((left, at[left].copy(), length))
            at[left] += np.maximum(length, 1)
            left = left[at[left] < self.ends[left]]
        passage, start, length = map(np.concatenate, zip(*found))
        order = np.lexsort((start, passage))
        return passage[order], start[order], length[order]

    def repeated(self, window: int = WINDOW) -> list[np.ndarray]:
        """Of each passage, the starts of windows that occur in a passage of an earlier document.

        Such a window lies in one factor, or ends the one it begins in and is reached to
        its end by the next, which takes the longest match there is. So the windows
        across a boundary need a check only where both factors together are longer.
        """
        passage, start, length = self.factors()
        hits = [_counted(start, length - window + 1)]
        joint = (passage[1:] == passage[:-1]) & (length[:-1] > 0) & (length[:-1] + length[1:] >= window) if len(passage) else np.empty(0, bool)
        left = np.flatnonzero(joint)
        boundary, reach = start[left + 1], start[left + 1] + length[left + 1] - window
        first = np.maximum(np.maximum(start[left], start[left] + length[left] - window + 1), boundary - window + 1)
        asked = _counted(first, np.minimum(boundary - 1, reach) - first + 1)
        hits.append(asked[self.longest(asked) >= window])
        all_hits = np.unique(np.concatenate(hits))
        cut = np.searchsorted(all_hits, self.starts)
        return [h - s for h, s in zip(np.split(all_hits, cut[1:]), self.starts)]


def _counted(first: np.ndarray, count: np.ndarray) -> np.ndarray:
    """first, first + 1, ... `count` numbers from each first; none of a count below 1."""
    count = np.maximum(count, 0)
    return np.repeat(first - (np.cumsum(count) - count), count) + np.arange(int(count.sum()))


_ITEMS = "key long, passage long, anchor long, whole long, doc long, shift int, low int, high int, at int, words binary"


def _node(words: np.ndarray, at: int, low: int, high: int, window: int) -> int:
    """The key of what all windows share that begin `low` to `high` words before the anchor at `at`."""
    shared = words[at - low : at - high + window].tobytes()
    made = hashlib.blake2b(shared + bytes((low, high)), digest_size=8).digest()
    return int.from_bytes(made, "little", signed=True)


def _split(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each passage of a crowded key in two, by how far its windows begin before the anchor.

    `low` to `high`: the distances that the key stands for. The windows of either half
    share more words around the anchor; these make the half's key, and the passage is
    cut to the half's windows, so passages that differ farther out become equal.
    """
    names = [c.split()[0] for c in _ITEMS.split(", ")]
    for batch in rows:
        made = []
        for r in batch.to_pylist():
            words, middle = np.frombuffer(r["words"], np.uint64), (r["low"] + r["high"]) // 2
            windows = len(words) - WINDOW + 1
            for low, high in ((r["low"], middle), (middle + 1, r["high"])):
                first, last = max(0, r["at"] - high), min(windows - 1, r["at"] - low)
                if first <= last:
                    part = words[first : last + WINDOW]
                    passage = int.from_bytes(hashlib.blake2b(part.tobytes(), digest_size=8).digest(), "little", signed=True)
                    key = _node(part, r["at"] - first, low, high, WINDOW)
                    made.append({**r, "key": key, "passage": passage, "shift": r["shift"] + first, "low": low, "high": high, "at": r["at"] - first, "words": part.tobytes()})
        if made:
            yield pa.RecordBatch.from_pylist(made, schema=_arrow(names))


def _arrow(names: list[str]) -> pa.Schema:
    kinds = {"words": pa.binary(), "shift": pa.int32(), "low": pa.int32(), "high": pa.int32(), "at": pa.int32()}
    return pa.schema([(n, kinds.get(n, pa.int64())) for n in names])


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The words of the wanted passages of each text."""
    names = [c.split()[0] for c in _ITEMS.split(", ")]
    for batch in batches:
        data, offsets = flat(batch.column("text"))
        wanted = batch.column("wanted")
        for a, b in row_slices(offsets):
            words, begins = hashed_words(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
            made = []
            for k in range(b - a):
                own = words[begins[k] : begins[k + 1]]
                for w in wanted[a + k].as_py():
                    part = own[w["first"] : w["last"] + WINDOW].tobytes()
                    made.append((w["anchor"], w["passage"], w["anchor"], w["passage"], w["doc"], 0, 0, WINDOW - ANCHOR, w["place"] - w["first"], part))
            if made:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*made), _arrow(names))], names=names)


def _parsed(table: pa.Table) -> pa.Table:
    """The repeated windows of a block's passages, as spans of window starts."""
    table = table.sort_by([("doc", "ascending"), ("key", "ascending"), ("passage", "ascending")])
    passages = [np.frombuffer(w.as_py(), np.uint64) for w in table.column("words")]
    found = Reference(passages, table.column("doc").to_numpy()).repeated()
    spans = [[{"a": a, "b": b} for a, b in _spans(h)] for h in found]
    kind = pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32())]))
    return table.select(["key", "passage", "doc"]).append_column("spans", pa.array(spans, kind))


def _spans(numbers: np.ndarray) -> list[tuple[int, int]]:
    """(first, last) of each run of consecutive numbers."""
    if not len(numbers):
        return []
    cut = np.flatnonzero(np.diff(numbers) != 1)
    return list(zip(numbers[np.append(0, cut + 1)].tolist(), numbers[np.append(cut, len(numbers) - 1)].tolist()))


def _kinds(items: DataFrame) -> DataFrame:
    """The different passages of each key, with their first document."""
    return items.groupBy("key", "passage").agg(F.min("doc").alias("doc"), F.min("words").alias("words"))


def parse(items: DataFrame) -> DataFrame:
    """(`anchor`, `whole`, `spans`): the repeated windows of each passage around an anchor with several.

    Passages of one key meet in one block. A key with more than `MOST_PASSAGES` different
    ones is split by its context, and again, until its halves hold fewer or stand for
    one distance, where equal keys are equal windows. So no group grows with the number
    of copies of a passage, in whatever different surroundings they stand.
    """
    done, open_items = [], items
    while True:
        sizes = open_items.groupBy("key").agg(F.count_distinct("passage").alias("n")).where(F.col("n") > MOST_PASSAGES)
        crowded = settle(sizes.select("key"), "crowded")
        if crowded.isEmpty():
            done.append(open_items)
            break
        done.append(open_items.join(crowded, "key", "left_anti"))
        split = open_items.join(crowded, "key", "left_semi").where("low < high")
        open_items = settle(split.mapInArrow(_split, _ITEMS), "split")
    all_items = done[0]
    for more in done[1:]:
        all_items = all_items.unionByName(more)
    kinds = settle(_kinds(all_items), "kinds")
    blocks = kinds.count() // BLOCK_PASSAGES + 1
    found = (
        kinds.withColumn("block", F.pmod(F.xxhash64("key"), F.lit(blocks)))
        .groupBy("block")
        .applyInArrow(_parsed, "key long, passage long, doc long, spans array<struct<a:int,b:int>>")
    )
    found = settle(found.withColumnRenamed("doc", "first_doc"), "parsed")
    whole = F.array(F.struct(F.lit(0).alias("a"), (F.octet_length("words") / 8 - WINDOW).cast("int").alias("b")))
    hits = all_items.join(found, ["key", "passage"]).select(
        "anchor",
        "whole",
        F.transform(
            F.when(F.col("doc") > F.col("first_doc"), whole).otherwise(F.col("spans")),
            lambda x: F.struct((x["a"] + F.col("shift")).alias("a"), (x["b"] + F.col("shift")).alias("b")),
        ).alias("spans"),
    )
    return hits.where(F.size("spans") > 0).groupBy("anchor", "whole").agg(F.flatten(F.collect_list("spans")).alias("spans"))


def repeated_spans(numbered: DataFrame) -> DataFrame:
    """(`row`, `spans`): the runs of window starts of each text (`row`, `doc`, `text`) that an earlier document holds.

    `doc` orders the documents; texts of the same `doc` do not repeat each other.
    """
    found = settle(numbered.select("row", "doc", F.col("text").cast("binary").alias("text")).mapInArrow(_runs_of, _RUNS), "runs")
    anchors = found.groupBy("anchor").agg(
        F.min("doc").alias("least"), F.max("doc").alias("most"), (F.min("passage") < F.max("passage")).alias("several")
    )
    common = settle(anchors.where("least < most").select("anchor", "several"), "common")
    shared = settle(found.join(common, "anchor"), "shared")
    firsts = shared.groupBy("anchor", "passage").agg(
        F.min("doc").alias("first_doc"), F.max("doc").alias("last_doc"), F.max("several").alias("several"),
        F.min(F.struct("doc", "row", "first", "last", "place")).alias("one"),
    )
    firsts = settle(firsts, "firsts")
    wanted = firsts.where("several").groupBy(F.col("one.row").alias("row")).agg(
        F.collect_list(F.struct("anchor", "passage", "one.doc", "one.first", "one.last", "one.place")).alias("wanted")
    )
    cut = numbered.join(settle(wanted, "wanted"), "row").select(F.col("text").cast("binary").alias("text"), "wanted")
    parsed = parse(settle(cut.mapInArrow(_cut, _ITEMS), "items")).withColumnRenamed("whole", "passage")
    known = firsts.select("anchor", "passage", "first_doc", "last_doc").join(settle(parsed, "spans"), ["anchor", "passage"], "left")
    known = settle(known.where("first_doc < last_doc or spans is not null").select("anchor", "passage", "first_doc", "spans"), "known")
    whole = F.array(F.struct(F.lit(0).alias("a"), (F.col("last") - F.col("first")).alias("b")))
    placed = shared.join(known, ["anchor", "passage"]).select(
        "row",
        F.transform(
            F.when(F.col("doc") > F.col("first_doc"), whole).otherwise(F.col("spans")),
            lambda x: F.struct((x["a"] + F.col("first")).alias("a"), (x["b"] + F.col("first")).alias("b")),
        ).alias("spans"),
    )
    return placed.where(F.size("spans") > 0).groupBy("row").agg(F.flatten(F.collect_list("spans")).alias("spans"))


_KEPT = "doc_id long, n_words long, n_removed long, removed array<struct<a:int,b:int>>, kept binary"


def _kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kind = pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32())]))
    names = [c.split()[0] for c in _KEPT.split(", ")[:3]] + ["removed", "kept"]
    for batch in batches:
        data, offsets = flat(batch.column("text"))
        for a, b in row_slices(offsets):
            part, here = data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]
            starts, ends, rows = word_spans(part, here, NOT_BLANK)
            begins = np.searchsorted(rows, np.arange(b - a + 1))
            steps = np.zeros(len(starts) + 1, np.int64)
            for k, spans in enumerate(batch.column("spans").slice(a, b - a)):
                for span in spans.as_py() or ():
                    steps[begins[k] + span["a"]] += 1
                    steps[begins[k] + span["b"] + WINDOW] -= 1
            gone = np.cumsum(steps)[:-1] > 0
            keep = ~gone
            # kept words, each with one space after it but the last of its row
            sizes = (ends - starts + 1)[keep]
            kept_rows = rows[keep]
            n = np.bincount(kept_rows, minlength=b - a)
            last = np.cumsum(n)[n > 0] - 1
            sizes[last] -= 1
            within = _counted(starts[keep], sizes)
            text = part[np.minimum(within, len(part) - 1)]
            blank = np.cumsum(sizes) - 1
            blank = np.delete(blank, last)
            text[blank] = 32
            per_row = np.concatenate([[0], np.cumsum(np.bincount(kept_rows, weights=sizes, minlength=b - a).astype(np.int64))])
            kept = pa.LargeBinaryArray.from_buffers(pa.large_binary(), b - a, [None, pa.py_buffer(per_row), pa.py_buffer(np.ascontiguousarray(text))])
            removed = [[{"a": x, "b": y + 1} for x, y in _spans(np.flatnonzero(gone[begins[k] : begins[k + 1]]))] for k in range(b - a)]
            columns = [
                batch.column("doc_id").slice(a, b - a), pa.array(np.diff(begins), pa.int64()),
                pa.array(np.bincount(rows[gone], minlength=b - a), pa.int64()), pa.array(removed, kind), kept.cast(pa.binary()),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=names)


def remove_passages(docs: DataFrame) -> DataFrame:
    """What is left of each text of `docs` (doc_id, text) without the passages of documents with smaller ids.

    Words are runs of bytes other than blanks, taken as they are. A word goes if a window
    of 50 words that covers it also starts in a document with a smaller doc_id; windows
    are judged on the input. Null texts have no words; texts under 50 words lose nothing.
    Rows that repeat a doc_id don't repeat each other. A null doc_id counts as larger
    than all others, and rows with one don't repeat each other either.

    Columns: doc_id, n_words, n_removed, `removed` (first word and word after the last of
    each maximal run), `kept` (the kept words joined by one space, UTF-8).
    """
    largest = (1 << 63) - 1
    numbered = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), "text", F.monotonically_increasing_id().alias("row"),
        F.coalesce(F.col("doc_id").cast("long"), F.lit(largest)).alias("doc"),
    )
    numbered = settle(numbered, "numbered")
    spans = settle(repeated_spans(numbered.where(F.octet_length("text") >= 2 * WINDOW - 1)), "spans")
    joined = numbered.join(spans, "row", "left").select("doc_id", F.col("text").cast("binary").alias("text"), "spans")
    return joined.mapInArrow(_kept, _KEPT)
