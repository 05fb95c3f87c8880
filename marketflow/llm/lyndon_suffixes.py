"""Suffix-array dedup: remove every byte of a long string that occurs more than once.

Equal windows of `LENGTH` bytes are brought together by an anchor, the least hashed
substring inside the window, which equal windows share. Around anchors that occur more
than once lie the only bytes that can repeat; their texts are sorted by suffix arrays,
built by Lyndon grouping, in which equal windows are neighbours. In these arrays an anchor
is one symbol, and so are eight bytes after it (see `recoded`).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketflow.llm.common import broadcast_if_small
from marketflow.session import settle

#: bytes of a repeated string, and of the substrings among which its anchor is chosen
LENGTH, ANCHOR = 200, 100
#: symbols of recoded text that one suffix array is built over, and windows that a long text is cut into at a time
ARRAY_BYTES, BLOCK = 200_000, 1 << 22
#: bytes after an anchor that are one symbol; texts whose pieces are held at a time; arrays that a task builds
PACKED, TEXTS_HELD, ARRAYS_PER_TASK = 8, 256, 8
BROADCAST_ROWS = 2_000_000
_RANDOM = np.random.default_rng(3)
_BYTES = _RANDOM.integers(0, 2**63, 256, dtype=np.uint64)
_BASE, _UNBASE = 0x9E3779B97F4A7C15, pow(0x9E3779B97F4A7C15, -1, 2**64)
_LOW = np.uint64(0xFFFFFF)


def suffix_array(text: list[int]) -> list[int]:
    """The starts of the suffixes of `text` in ascending order.

    First the suffixes are grouped by their Lyndon prefixes. Groups begin as single
    symbols and are processed from the highest down. For each suffix of the group the
    previous-smaller pointer leads to the nearest suffix before it in a group not yet
    processed; that suffix's prefix grows by the group's string, once per pointer to it,
    so it moves to a new group just above its old one, higher for more repetitions.
    Then, from the lowest suffix on, each suffix places those whose Lyndon prefix ends
    where it begins at the front of their groups. Pointers of a group never go back, so
    every list stays in text order without sorting, and no names are assigned anew.
    """
    n = len(text)
    if not n:
        return []
    symbols = sorted(set(text))
    number = {symbol: k for k, symbol in enumerate(symbols)}
    group = [number[symbol] for symbol in text]
    members: list[list[int]] = [[] for _ in symbols]
    for s, g in enumerate(group):
        members[g].append(s)
    lower = list(range(-1, len(symbols) - 1))
    upper = [*range(1, len(symbols)), -1]
    previous, done = [-1] * n, bytearray(n)

    g = len(symbols) - 1
    while g >= 0:
        here = [s for s in members[g] if group[s] == g]
        members[g] = here
        grown: dict[int, dict[int, list[int]]] = {}
        last, times = -1, 0
        for s in here:
            p = s - 1
            while p >= 0 and done[p]:
                p = previous[p]
            previous[s] = p
            done[s] = 1
            if p == last:
                times += 1
                continue
            if last >= 0:
                grown.setdefault(group[last], {}).setdefault(times, []).append(last)
            last, times = p, 1
        if last >= 0:
            grown.setdefault(group[last], {}).setdefault(times, []).append(last)
        for old, by_times in grown.items():
            below = old
            for times in sorted(by_times):
                new, above = len(members), upper[below]
                moved = by_times[times]
                members.append(moved)
                for p in moved:
                    group[p] = new
                lower.append(below)
                upper.append(above)
                upper[below] = new
                if above >= 0:
                    lower[above] = new
                below = new
        g = lower[g]

    front, at, g = [0] * len(members), 0, 0
    while g >= 0:  # the group of the lowest symbol stays the lowest
        front[g] = at
        at += len(members[g])
        g = upper[g]
    order, placed = [0] * n, bytearray(n)
    for rank in range(-1, n - 1):
        s = (order[rank] if rank >= 0 else n) - 1
        while s >= 0 and not placed[s]:
            g = group[s]
            order[front[g]] = s
            front[g] += 1
            placed[s] = 1
            s = previous[s]
    return order


def _mixed(values: np.ndarray) -> np.ndarray:
    values = (values ^ (values >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return values ^ (values >> np.uint64(29))


class _Powers:
    """Powers of the hash's base and of its inverse, as far as needed."""

    def __init__(self):
        self.up = self.down = np.ones(1, np.uint64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            self.up, self.down = (
                np.concatenate([[np.uint64(1)], np.cumprod(np.full(n, base, np.uint64))]) for base in (_BASE, _UNBASE)
            )
        return self.up[:n], self.down[:n]


def anchored_runs(data: np.ndarray, powers: _Powers, length: int = LENGTH, anchor: int = ANCHOR) -> tuple[np.ndarray, ...]:
    """(anchor hashes, first and last window starts, place of the anchor) of the runs of windows that share an anchor.

    The anchor of a window is its least substring of `anchor` bytes by hash, the first
    of equal ones: it depends on nothing but the window's bytes.
    """
    count = len(data) - anchor + 1
    up, down = powers.upto(len(data) + 1)
    total = np.concatenate([[np.uint64(0)], np.cumsum(_BYTES[data] * up[: len(data)])])
    hashes = _mixed((total[anchor:] - total[:-anchor]) * down[:count])
    keyed = (hashes & ~_LOW) | np.arange(count, dtype=np.uint64)
    # least of every `width` neighbours, from the running minima inside blocks of that width
    width = length - anchor + 1
    rows = -(-count // width)
    padded = np.full(rows * width, np.iinfo(np.uint64).max, np.uint64)
    padded[:count] = keyed
    square = padded.reshape(rows, width)
    head = np.minimum.accumulate(square, 1).ravel()
    tail = np.minimum.accumulate(square[:, ::-1], 1)[:, ::-1].ravel()
    windows = len(data) - length + 1
    place = (np.minimum(tail[:windows], head[width - 1 : width - 1 + windows]) & _LOW).astype(np.int64)
    first = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1]]))
    last = np.append(first[1:], windows) - 1
    return hashes[place[first]].view(np.int64), first, last, place[first]


def _runs_of(text: str | None, powers: _Powers) -> Iterator[tuple[bytes, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(bytes, anchors, first and last window starts, bytes before the anchor) of each block of a text."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    data = np.frombuffer(raw, np.uint8)
    for start in range(0, len(data) - LENGTH + 1, BLOCK):
        anchors, first, last, place = anchored_runs(data[start : start + BLOCK + LENGTH - 1], powers)
        yield raw, anchors, first + start, last + start, place - first


def _anchors(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    powers = _Powers()
    for batch in batches:
        for start in range(0, len(batch), TEXTS_HELD):
            found = [np.empty(0, np.int64)]
            for text in batch["text"].iloc[start : start + TEXTS_HELD]:
                found += [anchors for _, anchors, *_ in _runs_of(text, powers)]
            anchors, n = np.unique(np.concatenate(found), return_counts=True)
            yield pd.DataFrame({"anchor": anchors, "n": n})


def _pieces(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    powers = _Powers()
    for batch in batches:
        for start in range(0, len(batch), TEXTS_HELD):
            part = batch.iloc[start : start + TEXTS_HELD]
            rows, pieces, found = [np.empty(0, np.int64)], [], [[np.empty(0, np.int64)] for _ in range(4)]
            for row, text in zip(part["row"], part["text"]):
                for raw, *run in _runs_of(text, powers):
                    _, first, last, _ = run
                    pieces += [xxhash.xxh3_64_intdigest(raw[a:b]) for a, b in zip(first.tolist(), (last + LENGTH).tolist())]
                    rows.append(np.full(len(first), row, np.int64))
                    for held, values in zip(found, run):
                        held.append(values)
            anchors, first, last, before = map(np.concatenate, found)
            yield pd.DataFrame(
                {
                    "anchor": anchors,
                    "piece": np.array(pieces, np.uint64).view(np.int64),
                    "row": np.concatenate(rows),
                    "first": first.astype(np.int32),
                    "last": last.astype(np.int32),
                    "before": before.astype(np.int32),
                }
            )


def _cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        made = []
        for text, wanted in zip(batch["text"], batch["wanted"]):
            raw = text.encode("utf-8", "surrogatepass")
            made += [(w["anchor"], w["piece"], w["before"], raw[w["first"] : w["last"] + LENGTH]) for w in wanted]
        yield pd.DataFrame(made, columns=["anchor", "piece", "before", "bytes"])


def _spans(flags: np.ndarray) -> list[tuple[int, int]]:
    """(first, last) of each run of true flags."""
    edges = np.flatnonzero(np.diff(np.concatenate([[0], flags.astype(np.int8), [0]])))
    return [(int(a), int(b) - 1) for a, b in edges.reshape(-1, 2)]


def recoded(pieces: list[bytes], before: list[int], anchor: int = ANCHOR) -> tuple[list[int], np.ndarray]:
    """(symbols of all texts, where each text starts in them), with far fewer symbols than bytes.

    The bytes before a text's anchor are symbols of their own, the anchor is one, and
    every `PACKED` bytes after it are one, numbered in the order of the bytes (the last ones
    filled up with zeros). Windows begin at their anchor or before it and equal ones
    have it at the same place, so what follows is packed alike: those equal to a window
    stay neighbours among the suffixes that begin whole windows.
    """
    packed, counts, anchors = [], [], {}
    for piece, at in zip(pieces, before):
        after = piece[at + anchor :]
        counts.append(-(-len(after) // PACKED))
        packed.append(after.ljust(counts[-1] * PACKED, b"\0"))
    values, symbol = np.unique(np.frombuffer(b"".join(packed), f">u{PACKED}"), return_inverse=True)
    ends = np.cumsum(counts).tolist()
    symbol, text, starts = (symbol + 257).tolist(), [], []
    for piece, at, count, end in zip(pieces, before, counts, ends):
        starts.append(len(text))
        text += [byte + 1 for byte in piece[:at]]
        text.append(257 + len(values) + anchors.setdefault(piece[at : at + anchor], len(anchors)))
        text += symbol[end - count : end]
        text.append(0)
    return text, np.array(starts, np.int64)


def repeated_windows(pieces: list[bytes], before: list[int], length: int = LENGTH, anchor: int = ANCHOR) -> list[np.ndarray]:
    """For each text a flag per window: whether its bytes occur at another place of these texts.

    `before`: the bytes before each text's anchor, which all its windows hold. The texts
    are recoded and sorted in one suffix array; the windows equal to a suffix's first
    bytes are its neighbours among the suffixes that begin a whole window.
    """
    text, starts = recoded(pieces, before, anchor)
    order = np.array(suffix_array(text), np.int64)
    sizes = [max(0, len(p) - length + 1) for p in pieces]
    data = np.frombuffer(b"".join(pieces), np.uint8)
    # the place in the bytes of each whole window, by its place in the symbols
    place = np.full(len(text), -1)
    for start, size, byte in zip(starts, sizes, np.cumsum([0] + [len(p) for p in pieces])):
        place[start : start + size] = np.arange(byte, byte + size)
    order = order[place[order] >= 0]
    views = np.lib.stride_tricks.sliding_window_view(data, length) if len(data) >= length else data.reshape(-1, 1)
    again = np.zeros(len(text), bool)
    for at in range(0, len(order) - 1, 1 << 16):
        left, right = order[at : at + (1 << 16)], order[at + 1 : at + 1 + (1 << 16)]
        left = left[: len(right)]
        same = (views[place[left]] == views[place[right]]).all(1)
        again[left[same]] = again[right[same]] = True
    return [again[start : start + size] for start, size in zip(starts, sizes)]


SPANS = "anchor long, piece long, spans array<struct<a:int,b:int>>"


def _sorted_group(frame: pd.DataFrame) -> pd.DataFrame:
    frame = frame.sort_values(["anchor", "piece"])
    flags = repeated_windows([bytes(b) for b in frame["bytes"]], frame["before"].tolist())
    return pd.DataFrame(
        {"anchor": frame["anchor"], "piece": frame["piece"], "spans": [[{"a": a, "b": b} for a, b in _spans(f)] for f in flags]}
    )


def _windows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for anchor, piece, raw in zip(batch["anchor"], batch["piece"], batch["bytes"]):
            raw = bytes(raw)
            places = range(len(raw) - LENGTH + 1)
            yield pd.DataFrame(
                {"anchor": anchor, "piece": piece, "place": places, "window": [hashlib.md5(raw[k : k + LENGTH]).digest() for k in places]}
            )


def repeated_spans(numbered: DataFrame) -> DataFrame:
    """(`row`, `spans`): the runs of window starts of each text (`row`, `text`) whose windows repeat.

    Anchors are counted over all texts. Where an anchor's surroundings are the same
    everywhere, they repeat as a whole; where they differ, the different ones meet in
    suffix arrays of about `ARRAY_BYTES` symbols. An anchor with more different
    surroundings than fit in one array (a passage that very many texts share) has its
    windows counted by their digests instead, which a shuffle spreads over all tasks.
    """
    counted = numbered.select("text").mapInPandas(_anchors, "anchor long, n long")
    common = settle(counted.groupBy("anchor").agg(F.sum("n").alias("n")).where("n > 1").select("anchor"), "anchors")
    pieces = numbered.select("row", "text").mapInPandas(
        _pieces, "anchor long, piece long, row long, first int, last int, before int"
    )
    found = settle(pieces.join(broadcast_if_small(common, BROADCAST_ROWS), "anchor", "left_semi"), "pieces")
    kinds = settle(
        found.groupBy("anchor", "piece").agg(F.count("*").alias("n"), F.min(F.struct("row", "first", "last", "before")).alias("one")),
        "kinds",
    )
    after = F.col("one.last") - F.col("one.first") + LENGTH - ANCHOR - F.col("one.before")
    symbols = F.col("one.before") + F.ceil(after / PACKED) + 2
    held = kinds.groupBy("anchor").agg(F.count("*").alias("kinds"), F.sum(symbols).alias("symbols"))
    mixed = settle(held.where("kinds > 1").select("anchor", "symbols"), "mixed")
    wanted = (
        kinds.join(mixed, "anchor")
        .groupBy(F.col("one.row").alias("row"))
        .agg(F.collect_list(F.struct("anchor", "piece", "one.first", "one.last", "one.before")).alias("wanted"))
    )
    wanted = settle(wanted, "wanted")
    cut = numbered.join(broadcast_if_small(wanted, BROADCAST_ROWS // 20), "row").select("text", "wanted")
    texts = settle(
        cut.mapInPandas(_cut, "anchor long, piece long, before int, bytes binary").join(mixed, "anchor"),
        "texts",
    )
    groups = int((mixed.where(F.col("symbols") <= ARRAY_BYTES).agg(F.sum("symbols")).first()[0] or 0) // ARRAY_BYTES) + 1
    by_array = (
        texts.where(F.col("symbols") <= ARRAY_BYTES)
        .withColumn("group", F.pmod(F.xxhash64("anchor"), F.lit(groups)))
        .select("group", "anchor", "piece", "before", "bytes")
        # a number of its own: sorting takes far longer than the size of these texts tells
        .repartition(groups // ARRAYS_PER_TASK + 1, "group")
        .groupBy("group")
        .applyInPandas(_sorted_group, SPANS)
    )
    windows = settle(
        texts.where(F.col("symbols") > ARRAY_BYTES).select("anchor", "piece", "bytes").mapInPandas(
            _windows, "anchor long, piece long, place int, window binary"
        ),
        "windows",
    )
    again = windows.groupBy("window").agg(F.count("*").alias("n")).where("n > 1").select("window")
    by_count = (
        windows.join(again, "window")
        .groupBy("anchor", "piece")
        .agg(F.collect_list(F.struct(F.col("place").alias("a"), F.col("place").alias("b"))).alias("spans"))
    )
    partly = settle(by_array.union(by_count), "partly")
    everywhere = F.array(F.struct(F.lit(0).alias("a"), (F.col("one.last") - F.col("one.first")).alias("b")))
    spans = (
        kinds.join(partly, ["anchor", "piece"], "left")
        .select("anchor", "piece", F.when(F.col("n") > 1, everywhere).otherwise(F.col("spans")).alias("spans"))
        .where(F.size("spans") > 0)
    )
    placed = found.join(settle(spans, "spans"), ["anchor", "piece"]).select(
        "row",
        F.transform("spans", lambda x: F.struct((x["a"] + F.col("first")).alias("a"), (x["b"] + F.col("first")).alias("b"))).alias("spans"),
    )
    return placed.groupBy("row").agg(F.flatten(F.collect_list("spans")).alias("spans"))


def _kept(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        rows = []
        for doc_id, text, spans in zip(batch["doc_id"], batch["text"], batch["spans"]):
            raw = (text or "").encode("utf-8", "surrogatepass")
            steps = np.zeros(len(raw) + 1, np.int64)
            for span in spans if spans is not None else ():
                steps[span["a"]] += 1
                steps[span["b"] + LENGTH] -= 1
            gone = np.cumsum(steps)[:-1] > 0
            kept = np.frombuffer(raw, np.uint8)[~gone].tobytes()
            rows.append((doc_id, len(raw), int(gone.sum()), [{"a": a, "b": b + 1} for a, b in _spans(gone)], kept))
        made = pd.DataFrame(rows, columns=["doc_id", "n_bytes", "n_removed", "removed", "kept"])
        yield made.astype({"doc_id": "Int64"})


def remove_repeats(docs: DataFrame) -> DataFrame:
    """What is left of each text of `docs` (doc_id, text) without its repeated strings.

    A byte goes if a string of 200 bytes that covers it also starts at another place of any
    text, the same one included; every such place loses it, overlaps count, and strings
    are judged on the input. Null texts are empty; texts under 200 bytes lose nothing;
    repeated rows are texts of their own, so both copies of a longer text go entirely.

    Columns: doc_id, n_bytes, n_removed, `removed` (first byte and byte after the last of
    each maximal run), `kept` (the remaining bytes; a cut may split a character).
    """
    numbered = settle(docs.select("doc_id", "text", F.monotonically_increasing_id().alias("row")), "numbered")
    spans = settle(repeated_spans(numbered.select("row", "text").where(F.octet_length("text") >= LENGTH)), "spans")
    joined = numbered.join(spans, "row", "left").select("doc_id", "text", "spans")
    return joined.mapInPandas(
        _kept, "doc_id long, n_bytes long, n_removed long, removed array<struct<a:int,b:int>>, kept binary"
    )
