"""Near-duplicate classes by MinHash with tensored banding.

Two small collections of `width` sub-keys each, every one made of `depth` minhashes, are
combined pairwise: `width` squared tables of `2 * depth` minhashes come from only
`2 * width * depth` minhashes. Candidates that share a table key are verified on their
full shingle sets.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketflow.llm.common import apart, broadcast_if_small, releasing, text_key
from marketflow.llm.components import components
from marketflow.llm.lempel_ziv import hashed_words
from marketflow.llm.spans import LOWER, NOT_BLANK, flat, row_slices
from marketflow.session import settle

#: the probability that a pair just similar enough shares no table key
MISSED = 1e-4
#: rounds of pivots before what is left of the keys' members is joined by its rarest shingles
PIVOT_ROUNDS = 2
#: bytes of text whose words are hashed at a time
BLOCK_BYTES = 1 << 18
#: classes of set sizes between a size and its double
SIZE_CLASSES = 24
BROADCAST_ROWS = 2_000_000
#: of the numbered texts, the largest table that is written
TEXT_CODEC = "zstd"
SEED = 11


def banding(percent: int) -> tuple[int, int]:
    """(`width`, `depth`): sub-keys of a collection and minhashes of a sub-key.

    A sub-key is shared with probability (percent / 100) ** depth, a collection shares
    none of its `width` with at most half of `MISSED`. At 80: 14 sub-keys of 3 minhashes.
    """
    depth = 3 if percent >= 75 else 2 if percent >= 50 else 1
    shared = min(max(percent, 1) / 100, 0.99) ** depth
    return max(1, math.ceil(math.log(MISSED / 2) / math.log(1 - shared))), depth


def _mixed(values: np.ndarray) -> np.ndarray:
    """A fixed bijection of 64-bit values that spreads them."""
    values = (values ^ (values >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    values = (values ^ (values >> np.uint64(29))) * np.uint64(0xD6E8FEB86659FD93)
    return values ^ (values >> np.uint64(32))


def shingle_set(words: np.ndarray, size: int) -> np.ndarray:
    """Sorted hashes of the distinct `size`-word shingles of hashed words; of fewer words, the whole sequence is one."""
    if not len(words):
        return np.empty(0, np.uint64)
    take = min(size, len(words))
    mixed = np.full(len(words) - take + 1, take, np.uint64)
    for k in range(take):
        mixed = _mixed(mixed * np.uint64(3) + words[k : len(words) - take + 1 + k])
    mixed.sort()
    return mixed[np.concatenate([[True], mixed[1:] != mixed[:-1]])]


def _coefficients(width: int, depth: int) -> tuple[np.ndarray, np.ndarray]:
    random = np.random.default_rng(SEED)
    count = 2 * width * depth
    return (
        random.integers(0, 2**63, count, dtype=np.uint64) * np.uint64(2) + np.uint64(1),
        random.integers(0, 2**63, count, dtype=np.uint64),
    )


def sub_keys(shingles: np.ndarray, odd: np.ndarray, shift: np.ndarray, width: int, depth: int) -> np.ndarray:
    """The 2 * width sub-keys of a set; keys of different slots never mean the same."""
    least = np.full(len(odd), np.iinfo(np.uint64).max, np.uint64)
    for start in range(0, len(shingles), 512):
        block = shingles[start : start + 512, None]
        np.minimum(least, ((block ^ shift) * odd).min(axis=0), out=least)
    keys = np.arange(2 * width, dtype=np.uint64)
    for k in range(depth):
        keys = _mixed(keys * np.uint64(5) + least[k :: depth])
    return keys


def _longs(arrays: list[np.ndarray]) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum([len(a) for a in arrays])]).astype(np.int32)
    flat = np.concatenate(arrays) if arrays else np.empty(0, np.uint64)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat.astype(np.uint64).view(np.int64)))


def _blocks(text: np.ndarray) -> Iterator[np.ndarray]:
    """The bytes of a text in blocks of about `BLOCK_BYTES` that end between words."""
    start = 0
    while start < len(text):
        end = start + BLOCK_BYTES
        while end < len(text):
            blank = np.flatnonzero(~NOT_BLANK[text[end : end + BLOCK_BYTES]])
            end += int(blank[0]) if len(blank) else BLOCK_BYTES
            if len(blank):
                break
        yield text[start:end]
        start = end


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> Iterator[list[np.ndarray]]:
    """The hashed lower-case words of each text, for a few texts at a time; a long text is hashed block by block."""
    for a, b in row_slices(offsets, BLOCK_BYTES):
        part = LOWER[data[offsets[a] : offsets[b]]]
        if len(part) > BLOCK_BYTES:  # one text
            yield [np.concatenate([hashed_words(block, np.array([0, len(block)]))[0] for block in _blocks(part)])]
        else:
            hashes, begins = hashed_words(part, offsets[a : b + 1] - offsets[a])
            yield [hashes[x:y] for x, y in zip(begins, begins[1:])]


def _in_batches(rows: DataFrame, function, schema: str) -> DataFrame:
    """`function(hashed words of each text) -> dict of Arrow arrays` over `text`, in bounded slices, beside the other columns."""
    kept = [c for c in rows.columns if c != "text"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            done = 0
            for texts in word_hashes(*flat(batch.column("text"))):
                yield pa.RecordBatch.from_pydict({**{c: batch.column(c).slice(done, len(texts)) for c in kept}, **function(texts)})
                done += len(texts)

    return rows.mapInArrow(releasing(run), schema)


def _signatures(rows: DataFrame, size: int, width: int, depth: int) -> DataFrame:
    def make(texts: list) -> dict:
        odd, shift = _coefficients(width, depth)
        sets = [shingle_set(words, size) for words in texts]
        keys = [sub_keys(s, odd, shift, width, depth) if len(s) else s for s in sets]
        return {"n_shingles": pa.array([len(s) for s in sets], pa.int64()), "keys": _longs(keys)}

    return _in_batches(rows.select("row", "text"), make, "row long, n_shingles long, keys array<long>")


def _sets(numbered: DataFrame, nodes: DataFrame, size: int) -> DataFrame:
    """`row`, the other columns of `nodes` (settled, `row` first) and `shingles` (the whole set) of the rows of `nodes`."""
    rows = numbered.select("row", "text").join(broadcast_if_small(nodes, BROADCAST_ROWS), "row").select(*nodes.columns, "text")
    schema = ", ".join(f"{c.name} {c.dataType.simpleString()}" for c in nodes.schema)
    return settle(
        _in_batches(rows, lambda texts: {"shingles": _longs([shingle_set(words, size) for words in texts])}, f"{schema}, shingles array<long>"),
        "sets",
    )


def _table_keys(signed: DataFrame, width: int) -> DataFrame:
    """(`key`, `node`, `weight`) for the table keys that have two members or more.

    A table key can only be shared if both its sub-keys are, so sub-keys with one
    holder are dropped before pairs are formed: an exact cut that leaves unique texts
    with no table keys at all. Of table keys with the same members one stands for all:
    members are told apart by their number and two 64-bit sums of hashes. `weight` is
    the number of members over all the keys that it stands for.
    """
    single = signed.select("node", F.posexplode("keys").alias("slot", "value"))
    shared = single.groupBy("value").agg(F.count("*").alias("n")).where("n > 1").select("value")
    kept = single.join(shared, "value")
    first = F.when(F.col("slot") < width, F.col("value"))
    second = F.when(F.col("slot") >= width, F.col("value"))
    halves = settle(
        kept.groupBy("node").agg(F.collect_list(first).alias("firsts"), F.collect_list(second).alias("seconds")), "halves"
    )
    keyed = (
        halves.select("node", F.explode("firsts").alias("first"), "seconds")
        .select("node", "first", F.explode("seconds").alias("second"))
        .select(F.xxhash64("first", "second").alias("key"), "node")
    )
    members = ["size", "one", "two"]
    held = keyed.groupBy("key").agg(
        F.count("*").alias("size"),
        F.bit_xor(F.xxhash64("node")).alias("one"),
        F.bit_xor(F.xxhash64("node", F.lit(1))).alias("two"),
    )
    chosen = held.where("size > 1").groupBy(*members).agg(F.min("key").alias("key"), F.count("*").alias("times"))
    chosen = settle(chosen.select("key", (F.col("size") * F.col("times")).alias("weight")), "shared")
    return keyed.join(chosen, "key")


def _verified(pairs: DataFrame, numbered: DataFrame, signed: DataFrame, size: int, percent: int) -> DataFrame:
    """The pairs (`a`, `b`) whose sets meet `100 * intersection >= percent * union`.

    Of each pair the node with more pairs is the hub. Sets are made with the hubs that
    they are compared with beside them, so a set goes straight to its hubs and is
    shuffled once per pair; only the sets of hubs go once more.
    """
    counts = signed.select("node", "n_shingles")
    bounded = (
        pairs.join(counts.select(F.col("node").alias("a"), F.col("n_shingles").alias("n_a")), "a")
        .join(counts.select(F.col("node").alias("b"), F.col("n_shingles").alias("n_b")), "b")
        .where(100 * F.least("n_a", "n_b") >= percent * F.greatest("n_a", "n_b"))
    )
    bounded = settle(bounded.select("a", "b"), "bounded")
    met = bounded.select(F.col("a").alias("node")).union(bounded.select(F.col("b").alias("node"))).groupBy("node").agg(F.count("*").alias("n"))
    met = settle(met, "met")
    a_is_hub = F.struct("n_a", "a") > F.struct(F.col("n_b").alias("n_a"), F.col("b").alias("a"))
    aimed = (
        bounded.join(met.select(F.col("node").alias("a"), F.col("n").alias("n_a")), "a")
        .join(met.select(F.col("node").alias("b"), F.col("n").alias("n_b")), "b")
        .select(F.when(a_is_hub, F.col("b")).otherwise(F.col("a")).alias("row"), F.when(a_is_hub, F.col("a")).otherwise(F.col("b")).alias("hub"))
    )
    aimed = settle(aimed, "aimed")
    every = aimed.select("row", "hub").union(aimed.select(F.col("hub").alias("row"), F.lit(None).cast("long").alias("hub")).distinct())
    # a null stands for the node itself as a hub
    nodes = every.groupBy("row").agg(F.collect_list("hub").alias("hubs"), F.max(F.col("hub").isNull()).alias("is_hub"))
    sets = _sets(numbered, settle(nodes, "nodes"), size)
    common = F.size(F.array_intersect("of_hub", "shingles"))
    return settle(
        sets.select(F.explode("hubs").alias("hub"), "row", "shingles")
        .join(sets.where("is_hub").select(F.col("row").alias("hub"), F.col("shingles").alias("of_hub")), "hub")
        .where(100 * common >= percent * (F.size("of_hub") + F.size("shingles") - common))
        .select(F.least("row", "hub").alias("a"), F.greatest("row", "hub").alias("b")),
        "verified",
    )


def _labelled(members: DataFrame, labels: DataFrame | None) -> DataFrame:
    if labels is None:
        return members.withColumn("label", F.col("node"))
    return members.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))


def _central_first(members: DataFrame) -> DataFrame:
    """`members` (key, node, weight) with `order`: smaller for a node that meets more others over all its keys.

    A text that many near copies were made from is closer to each of them than they are
    to each other, so it meets the most members and comes first. A node has at most
    width squared keys, so its window is small.
    """
    order = -F.sum("weight").over(Window.partitionBy("node"))
    return members.select("key", "node", order.alias("order"))


def _size_class(n: Column) -> Column:
    return F.floor(F.log2(n) * SIZE_CLASSES).cast("int")


def _rare_first(nodes: DataFrame, numbered: DataFrame, size: int, percent: int) -> DataFrame:
    """(`node`, `label`, `n`, `i`, `shingle`): shared shingles at the front of each set, rarest first.

    `i` is the place in the set, counted from 0. Only as many places are given as a linked
    set must share one of.
    """
    sets = _sets(numbered, nodes.select(F.col("node").alias("row")), size)
    held = sets.select(F.col("row").alias("node"), F.explode("shingles").alias("shingle"))
    common = settle(held.groupBy("shingle").agg(F.count("*").alias("held")).where("held > 1"), "common")
    ordered = F.sort_array(F.collect_list(F.struct(F.coalesce("held", F.lit(1)).alias("held"), "shingle")))
    ranked = held.join(common, "shingle", "left").groupBy("node").agg(ordered.alias("ordered"))
    sized = ranked.join(nodes, "node").withColumn("n", F.size("ordered"))
    front = F.slice("ordered", F.lit(1), F.col("n") - F.ceil(F.col("n") * percent / 100).cast("int") + 1)
    places = sized.select("node", "label", "n", F.posexplode(front).alias("i", "at")).where("at.held > 1")
    return settle(places.select("node", "label", "n", "i", "at.shingle"), "places")


def _pairs_between(nodes: DataFrame, numbered: DataFrame, size: int, percent: int) -> DataFrame:
    """Pairs of `nodes` (node, label) of different labels that may be linked; no link is missing.

    Shingles are ordered by their number of holders. If the first shingle that two sets
    have in common is at places i and j, at most the smaller of n_a - i and n_b - j are
    common, so that must reach the overlap that their sizes ask for. Sets meet at a
    shingle and the size class of the smaller one, which already bounds both places:
    near copies of one text, each with changes of its own, have these first and do not
    meet at the shingles that all of them share.
    """
    places = _rare_first(nodes, numbered, size, percent)
    least = F.ceil(F.col("n") * percent / 100)
    enough = (100 + percent) * (F.col("n") - F.col("i"))
    smaller = places.where(enough >= 2 * percent * F.col("n")).withColumn("class", _size_class(F.col("n")))
    # a set of a class has no fewer shingles than this
    low = F.greatest(least, F.floor(F.pow(F.lit(2.0), F.col("class") / SIZE_CLASSES)) - 1)
    larger = places.withColumn("class", F.explode(F.sequence(_size_class(least), _size_class(F.col("n"))))).where(
        enough >= percent * (F.col("n") + low)
    )
    one = smaller.select("class", "shingle", *[F.col(c).alias(f"{c}_a") for c in ("node", "label", "n", "i")])
    other = larger.select("class", "shingle", *[F.col(c).alias(f"{c}_b") for c in ("node", "label", "n", "i")])
    both = (100 + percent) * F.least(F.col("n_a") - F.col("i_a"), F.col("n_b") - F.col("i_b"))
    may = (
        (F.struct("n_a", "node_a") < F.struct(F.col("n_b").alias("n_a"), F.col("node_b").alias("node_a")))
        & (F.col("label_a") != F.col("label_b"))
        & (100 * F.col("n_a") >= percent * F.col("n_b"))
        & (both >= percent * (F.col("n_a") + F.col("n_b")))
    )
    met = one.join(other, ["class", "shingle"]).where(may)
    return met.select(F.least("node_a", "node_b").alias("a"), F.greatest("node_a", "node_b").alias("b"))


def _first_pivots(members: DataFrame) -> DataFrame:
    """(`key`, `pivot`, `pivot_label`): the most central member of each key, while every node is its own class."""
    first = members.groupBy("key").agg(F.min(F.struct("order", "node")).alias("p"))
    return first.select("key", F.col("p.node").alias("pivot"), F.col("p.node").alias("pivot_label"))


def _later_pivots(members: DataFrame) -> DataFrame:
    """The same for keys of several classes: the most central member outside the key's largest class."""
    classes = settle(
        members.groupBy("key", "label").agg(F.count("*").alias("n"), F.min(F.struct("order", "node")).alias("first")),
        "classes",
    )
    # the largest class by size, then by smallest label
    keys = (
        classes.groupBy("key")
        .agg(F.max(F.struct("n", (-F.col("label")).alias("least"))).alias("top"), F.count("*").alias("classes"))
        .where("classes > 1")
    )
    return (
        classes.join(keys, "key")
        .where(F.col("label") != -F.col("top.least"))
        .groupBy("key")
        .agg(F.min(F.struct("first", "label")).alias("p"))
        .select("key", F.col("p.first.node").alias("pivot"), F.col("p.label").alias("pivot_label"))
    )


def linked_nodes(signed: DataFrame, numbered: DataFrame, size: int, percent: int, width: int) -> DataFrame | None:
    """(`node`, `label`) of all nodes with a link; None if there are no links.

    In rounds, one member of each table key (the pivot) is compared with the key's other
    members; then components are formed. A member is done once it was a pivot, and a
    key once its other members are all in one component, since links inside a component
    change nothing. The first pivot is the most central member, later ones the most
    central outside the key's largest component. So a key with m near copies of one
    text costs about m comparisons, not m squared, and no link between different
    components that share a key stays untested: the members of keys that are open after
    `PIVOT_ROUNDS` rounds are joined by the rarest shingles of their sets.
    """
    members = settle(_central_first(_table_keys(signed, width)), "members")
    links, labels, tested = None, None, None
    for turn in range(PIVOT_ROUNDS + 1):
        open_members = _labelled(members, labels)
        pivots = settle(_later_pivots(open_members) if turn else _first_pivots(open_members), "pivots")
        if not pivots.limit(1).count():
            break
        open_members = settle(open_members.join(pivots, "key"), "open")
        if turn < PIVOT_ROUNDS:
            pairs = open_members.where("label <> pivot_label").select(
                F.least("node", "pivot").alias("a"), F.greatest("node", "pivot").alias("b")
            )
        else:
            pairs = _pairs_between(settle(open_members.select("node", "label").distinct(), "left"), numbered, size, percent)
        pairs = pairs.distinct()
        pairs = settle(pairs if tested is None else pairs.join(tested, ["a", "b"], "left_anti"), "pairs")
        tested = pairs if tested is None else tested.union(pairs)
        found = _verified(pairs, numbered, signed, size, percent)
        members = open_members.where("node <> pivot").select("key", "node", "order")
        if found.limit(1).count():
            links = found if links is None else links.union(found)
            labels = components(links)
    return labels


def near_duplicates(
    docs: DataFrame, size: int = 5, percent: int = 80
) -> tuple[DataFrame, DataFrame]:
    """Near-duplicate classes of `docs` (doc_id, text, more): (classes, numbered docs).

    classes: `row`, `doc_id`, `n_shingles`, `node` (a number per text), `label` (the
    class: a number, the same for linked texts), `component_id` (the smallest doc_id of
    the class). numbered: `docs` with the number `row`, settled.

    Two texts are linked if their sets of `size`-word shingles meet
    `100 * intersection >= percent * union`. Texts are words in lower case (A-Z); a
    text with fewer words is one shingle; null, empty and blank texts are classes of
    their own. Equal texts are one node, so copies cost nothing after the first pass.
    `component_id` ignores null ids and is null if a class has no other. Columns named
    `row` are replaced. `banding` chooses the tables by `percent`.
    """
    width, depth = banding(percent)
    numbered = settle(docs.withColumn("row", F.monotonically_increasing_id()), "numbered", compression=TEXT_CODEC)
    keyed = numbered.select("row", "doc_id", text_key(F.col("text")).alias("key"))
    signatures = settle(_signatures(numbered, size, width, depth), "signatures")
    rows = keyed.join(signatures.select("row", "n_shingles"), "row")
    full = settle(rows.where("n_shingles > 0"), "rows")
    nodes = settle(full.groupBy("key").agg(F.min("row").alias("node"), F.min("doc_id").alias("least_id")), "nodes")
    signed = settle(
        nodes.select(F.col("node").alias("row")).join(signatures, "row").withColumnRenamed("row", "node"), "signed"
    )
    labels = linked_nodes(signed, numbered, size, percent, width)
    labelled = settle(_labelled(nodes, labels), "labelled")
    least = labelled.groupBy("label").agg(F.min("least_id").alias("component_id"))
    named = settle(labelled.join(least, "label").select("key", "node", "label", "component_id"), "named")
    classes = full.join(named, "key").select("row", "doc_id", "n_shingles", "node", "label", "component_id")
    blank = rows.where("n_shingles = 0").select(
        "row", "doc_id", "n_shingles", F.col("row").alias("node"), F.col("row").alias("label"), F.col("doc_id").alias("component_id")
    )
    return settle(classes.union(blank), "classes"), numbered


def keep_one_each(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """`docs` with one row of each near-duplicate class: the smallest doc_id (nulls last), then the first row stored.

    All columns stay as they were, whatever their names. Rows with blank texts are all kept.
    """
    names, docs = docs.columns, apart(docs, "doc_id", "text")
    classes, numbered = near_duplicates(docs, size, percent)
    order = F.struct(F.col("doc_id").isNull().alias("missing"), "doc_id", "row")
    chosen = classes.groupBy("label").agg(F.min(order).alias("first")).select(F.col("first.row").alias("row"))
    dropped = settle(classes.select("row").join(chosen, "row", "left_anti"), "dropped")
    kept = numbered.join(broadcast_if_small(dropped, BROADCAST_ROWS), "row", "left_anti")
    return kept.select(*docs.columns).toDF(*names)
