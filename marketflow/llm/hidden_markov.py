"""A hidden Markov language model over words: Baum-Welch across partitions, exact scaled forward scores.

A state emits a class of words, and the class emits the word by its share of the class:
P(word | state) = P(class | state) * (c + 1/2) / sum over the class. Frequent words are
classes of their own, the others share classes by their first and last letters, so the
trained tables are small however many words the corpus has. Every task knows the counts
of the common words; those of all others stay in a distributed table.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketflow.llm.common import fold
from marketflow.llm.lempel_ziv import Rolling
from marketflow.llm.spans import LOWER, NOT_BLANK, flat, row_slices, word_spans
from marketflow.session import settle

#: words with this share of all tokens are classes of their own: at most its inverse many; other words share as many classes
FREQUENT, CLASSES = 2e-4, 4093
#: the counts of words with this share of all tokens go to every task: at most its inverse many, 16 bytes each
KNOWN = 1e-6
STATES, TURNS = 6, 6
#: bytes of text that are hashed at a time
SLICE_BYTES = 4_000_000
#: tokens of a block in the recursions
BLOCK_TOKENS = 200_000
#: expected counts are summed as whole numbers of this fraction, so their sum has no order
UNIT = 1 << 20
#: stands for the end of a text among the hashes of words
END = 0

_CODES = np.random.default_rng(23).integers(0, 2**63, 256, dtype=np.uint64)


def _hashed(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
    """Per slice of the rows: first row, last row, and of each word its 64-bit hash, its outer letters as a number and its row.

    Hashes stand for words everywhere here: among a billion words two meet with a chance of a few in a hundred.
    """
    data, offsets = flat(column)
    for first, last in row_slices(offsets, SLICE_BYTES):
        part = LOWER[data[offsets[first] : offsets[last]]]
        starts, ends, rows = word_spans(part, offsets[first : last + 1] - offsets[first], NOT_BLANK)
        hashes = Rolling(_CODES[part]).spans(starts, ends) ^ (ends - starts).astype(np.uint64)
        outer = part[starts], part[np.minimum(starts + 1, ends - 1)], part[np.maximum(ends - 2, starts)], part[ends - 1]
        letters = sum(byte.astype(np.int64) << 8 * k for k, byte in enumerate(outer))
        yield first, last, hashes.view(np.int64), letters, rows


def _partial_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for first, last, hashes, letters, _ in _hashed(batch.column("text")):
            ends = np.full(last - first, END)
            word, at, c = np.unique(np.concatenate([hashes, ends]), return_index=True, return_counts=True)
            letters = np.concatenate([letters, ends])[at]
            yield pa.RecordBatch.from_arrays([pa.array(word), pa.array(letters), pa.array(c)], names=["word", "letters", "c"])


def word_counts(texts: DataFrame) -> DataFrame:
    """(`word` as a hash, `letters`, `c`) over all rows of `text`, the end of each text counted as a word."""
    given = texts.select(F.col("text").cast("binary").alias("text"))
    parts = given.mapInArrow(_partial_counts, "word long, letters long, c long")
    return parts.groupBy("word").agg(F.min("letters").alias("letters"), F.sum("c").alias("c"))


@dataclass
class Vocabulary:
    """What every task knows of the words: all that occur `least` times, and sums by class.

    `words` (sorted hashes) with counts `c` and classes `kinds`; `ends`: texts; `every`:
    tokens; `distinct`: different ones; `sums`: smoothed tokens by class. The class of
    a word is its own number if it is frequent, else one by its first and last letters.
    """

    words: np.ndarray
    c: np.ndarray
    kinds: np.ndarray
    least: float
    ends: int
    every: int
    distinct: int
    sums: np.ndarray


def vocabulary(counts: DataFrame, share: float = KNOWN) -> Vocabulary:
    """The vocabulary of settled `word_counts`, with the words that have a `share` of all tokens, or enough for a class."""
    totals = counts.agg(
        F.sum("c").alias("n"), F.count("*").alias("v"), F.sum(F.when(F.col("word") == END, F.col("c"))).alias("ends")
    ).first()
    every, ends = int(totals["n"] or 0), int(totals["ends"] or 0)
    least = min(share, FREQUENT) * every
    named = counts.where(F.col("word") != END)
    known = named.where(F.col("c") >= least).orderBy("word").toArrow()  # 1 / share rows at most
    word, letters, c = (known.column(k).to_numpy().astype(np.int64) for k in ("word", "letters", "c"))
    own = c >= FREQUENT * every
    shared = 1 + int(own.sum())
    kinds = np.where(own, np.cumsum(own), shared + letters % CLASSES)
    sums = np.full(shared + CLASSES, 0.5)  # the unknown word of each class
    sums[1:shared] += c[own] + 0.5
    if ends:
        sums[0] += ends + 0.5
    rest = named.where(F.col("c") < FREQUENT * every).groupBy((F.col("letters") % CLASSES).alias("kind"))
    for row in rest.agg(F.sum("c").alias("c"), F.count("*").alias("v")).collect():  # a row per class
        sums[shared + row["kind"]] += row["c"] + 0.5 * row["v"]
    return Vocabulary(word, c, kinds, least, ends, every, int(totals["v"]), sums)


@dataclass
class Chain:
    """Start, transition and emission probabilities (classes by rows)."""

    start: np.ndarray
    move: np.ndarray
    emit: np.ndarray


def _blocks(texts: list[np.ndarray]) -> Iterator[list[int]]:
    """Places of the texts by falling length, cut into blocks of bounded tokens."""
    order = sorted(range(len(texts)), key=lambda k: -len(texts[k]))
    block, held = [], 0
    for k in order:
        if block and held + len(texts[k]) > BLOCK_TOKENS:
            yield block
            block, held = [], 0
        block.append(k)
        held += len(texts[k])
    if block:
        yield block


def _by_time(texts: list[np.ndarray]) -> tuple[np.ndarray, list[int]]:
    """The classes of texts of falling length, all first ones, then all second ones and so on, and where each place begins.

    Shorter texts drop out at the end.
    """
    lengths = np.array([len(t) for t in texts])
    alive = np.searchsorted(-lengths, -np.arange(1, lengths[0] + 1), side="right")
    stops = np.concatenate([[0], np.cumsum(alive)])
    places = np.arange(stops[-1]) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    seen = np.empty(stops[-1], texts[0].dtype)
    seen[stops[places] + np.repeat(np.arange(len(texts)), lengths)] = np.concatenate(texts)
    return seen, stops.tolist()


def log_likelihoods(texts: list[np.ndarray], chain: Chain) -> np.ndarray:
    """Natural log of the probability of each class sequence (never empty), by the scaled forward recursion."""
    result = np.zeros(len(texts))
    come, emit = chain.move.T.copy(), chain.emit.T.copy()  # a row a state, so that the steps run along the texts
    for block in _blocks(texts):
        seen, stops = _by_time([texts[k] for k in block])
        logs, state = np.zeros(len(block)), None
        for a, b in zip(stops, stops[1:]):
            state = (chain.start[:, None] if state is None else come @ state[:, : b - a]) * emit.take(seen[a:b], axis=1)
            scale = np.add.reduce(state, axis=0)
            state /= scale
            logs[: b - a] += np.log(scale)
        result[block] = logs
    return result


def expected_counts(texts: list[np.ndarray], chain: Chain) -> np.ndarray:
    """Expected starts, moves and emissions, laid out as rows: 1 + states + classes, by states."""
    states, classes = len(chain.start), len(chain.emit)
    total = np.zeros((1 + states + classes, states))
    come, emit = chain.move.T.copy(), chain.emit.T.copy()  # a row a state, so that the steps run along the texts
    for block in _blocks(texts):
        seen, stops = _by_time([texts[k] for k in block])
        ahead, scales = emit.take(seen, axis=1), np.empty(len(seen))
        alphas = np.empty_like(ahead)
        for t, (a, b) in enumerate(zip(stops, stops[1:])):
            state, scale = alphas[:, a:b], scales[a:b]
            if t:
                np.matmul(come, alphas[:, stops[t - 1] : stops[t - 1] + b - a], out=state)
            else:
                state[:] = chain.start[:, None]
            state *= ahead[:, a:b]
            np.add.reduce(state, axis=0, out=scale)
            state /= scale
        ahead /= scales
        betas, moves = np.ones_like(alphas), np.zeros((states, states))
        for t in range(len(stops) - 2, 0, -1):
            a, b, before = stops[t], stops[t + 1], stops[t - 1]
            later = ahead[:, a:b]
            later *= betas[:, a:b]
            moves += alphas[:, before : before + b - a] @ later.T
            np.matmul(chain.move, later, out=betas[:, before : before + b - a])
        alphas *= betas
        total[0] += alphas[:, : stops[1]].sum(1)
        total[1 : 1 + states] += moves * chain.move
        for k in range(states):
            total[1 + states :, k] += np.bincount(seen, alphas[k], minlength=classes)
    return total


def improved(counts: np.ndarray, classes: np.ndarray) -> Chain:
    """The chain of expected counts, smoothed so that everything stays possible.

    `classes`: the shares of the classes in the corpus, towards which emissions are smoothed.
    """
    states = counts.shape[1]
    start, move, emit = counts[0] + 0.1, counts[1 : 1 + states] + 0.1, counts[1 + states :] + 5.0 * classes[:, None]
    return Chain(start / start.sum(), move / move.sum(1, keepdims=True), emit / emit.sum(0))


def initial(classes: np.ndarray, states: int = STATES, seed: int = 5) -> Chain:
    """States that stay put and differ by chance."""
    noise = np.random.default_rng(seed).gamma(2.0, 0.5, (len(classes), states))
    emit = classes[:, None] * noise
    move = np.full((states, states), 0.05 / max(states - 1, 1))
    np.fill_diagonal(move, 0.95 if states > 1 else 1.0)
    return Chain(np.full(states, 1.0 / states), move, emit / emit.sum(0))


def _texts(column: Iterable[bytes]) -> list[np.ndarray]:
    return [np.frombuffer(seen, np.uint16).astype(np.int64) for seen in column]


def baum_welch(encoded: DataFrame, chain: Chain, classes: np.ndarray) -> Chain:
    """One turn over all rows of `encoded` (`seen`): counts per task, summed by cell across tasks."""
    states = len(chain.start)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = 0
        for batch in batches:
            if len(batch):
                total = total + expected_counts(_texts(batch["seen"]), chain)
        if isinstance(total, np.ndarray):
            cells = np.round(total.ravel() * UNIT).astype(np.int64)
            held = np.flatnonzero(cells)
            yield pd.DataFrame({"cell": held, "n": cells[held]})

    parts = encoded.select("seen").mapInPandas(run, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n"))
    counts = np.zeros((1 + states + len(classes)) * states)
    for row in parts.collect():  # states * (1 + states + classes) numbers, whatever the corpus
        counts[row["cell"]] = row["n"] / UNIT
    return improved(counts.reshape(-1, states), classes)


def encoded(docs: DataFrame, held: Vocabulary) -> DataFrame:
    """Per row of `docs` (doc_id, text, held_out): token figures, class sequence (`seen`, two bytes a token), and other words.

    `logs` sums log10(c + 1/2) and `known` counts the tokens of known words, `spread` sums the
    logs of the classes of all tokens; `rare` holds the hashes of words that the vocabulary
    lacks, as often as they occur.
    """
    shared = len(held.sums) - CLASSES
    log_c, log_sums, log_end = np.log10(held.c + 0.5), np.log10(held.sums), np.log10(held.ends + 0.5)
    names = ["row", "doc_id", "held_out", "n_tokens", "known", "logs", "spread", "rare", "seen"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, last, hashes, letters, rows in _hashed(batch.column("text")):
                n, kind, hit = last - first, shared + letters % CLASSES, np.zeros(len(hashes), bool)
                if len(held.words):
                    at = np.minimum(np.searchsorted(held.words, hashes), len(held.words) - 1)
                    hit = held.words[at] == hashes
                    kind[hit] = held.kinds[at[hit]]
                    logs = np.bincount(rows[hit], log_c[at[hit]], n)
                else:
                    logs = np.zeros(n)
                words = np.bincount(rows, minlength=n)
                stops = np.concatenate([[0], np.cumsum(words + 1)])
                seen = np.zeros(stops[-1], np.uint16)  # the end is class 0
                seen[np.arange(len(rows)) + rows] = kind
                bounds = np.searchsorted(rows[~hit], np.arange(n + 1))
                columns = [batch.column(c).slice(first, n) for c in ("row", "doc_id", "held_out")] + [
                    pa.array(words + 1, pa.int64()),
                    pa.array(np.bincount(rows[hit], minlength=n) + (held.ends > 0), pa.int64()),
                    pa.array(logs + log_end),
                    pa.array(np.bincount(rows, log_sums[kind], n) + log_sums[0]),
                    pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(hashes[~hit], pa.int64())),
                    pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer((2 * stops).astype(np.int32)), pa.py_buffer(seen)]),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    given = docs.select(
        F.monotonically_increasing_id().alias("row"),
        F.col("doc_id").cast("long").alias("doc_id"),
        "held_out",
        F.col("text").cast("binary").alias("text"),
    )
    schema = "row long, doc_id long, held_out boolean, n_tokens long, known long, logs double, spread double, rare array<long>, seen binary"
    return given.mapInArrow(run, schema)


def rare_logs(texts: DataFrame, counts: DataFrame) -> DataFrame:
    """(`row`, `rare_logs`, `rare_known`): the sums over the rare words of each row of `texts`, from their counts.

    One join of the rare tokens with the counts by hash, summed by row on both sides of the shuffle.
    """
    tokens = texts.select("row", F.explode("rare").alias("word")).join(counts.select("word", "c"), "word", "left")
    logs = F.log10(F.coalesce("c", F.lit(0)) + 0.5)
    return tokens.groupBy("row").agg(F.sum(logs).alias("rare_logs"), F.count("c").alias("rare_known"))


def score(
    docs: DataFrame, folds: int = 5, held_out: int = 1, states: int = STATES, turns: int = TURNS, known_share: float = KNOWN
) -> DataFrame:
    """Log10 probabilities of whole texts: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    Learns from rows whose crc32 of the id modulo `folds` is not `held_out` (null ids are
    learnt from). Tokens are words in lower case (A-Z) and one end per text; a null text
    is an empty one. `base_score` is the smoothed unigram model's, `score` the chain's.
    Every word outside the training words counts as one unknown word of its class, as
    the base has one unknown word in all. Rows of repeated ids are scored each.

    Training: word counts over all training rows, then `turns` turns of Baum-Welch over all
    training rows. Without training rows all counts are 0. Counts of words below
    `known_share` (at most `FREQUENT`) of all tokens are joined to the tokens, those above
    are known to every task.
    """
    docs = docs.select("doc_id", "text", (fold(F.col("doc_id"), folds) == held_out).alias("held_out"))
    counts = settle(word_counts(docs.where(~F.col("held_out"))), "counts")
    held = vocabulary(counts, known_share)
    texts = settle(encoded(docs, held), "encoded")
    training = texts.where(~F.col("held_out"))
    shares = held.sums / held.sums.sum()
    chain = initial(shares, states)
    if held.every:
        for _ in range(turns):
            chain = baum_welch(training, chain, shares)

    kept = ["row", "doc_id", "held_out", "n_tokens", "known", "logs", "spread"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            likely = log_likelihoods(_texts(batch.column("seen").to_pylist()), chain) / np.log(10)
            yield pa.RecordBatch.from_arrays([*map(batch.column, kept), pa.array(likely)], names=[*kept, "likely"])

    schema = "row long, doc_id long, held_out boolean, n_tokens long, known long, logs double, spread double, likely double"
    likely = texts.select(*kept, "seen").mapInArrow(run, schema)
    rare = rare_logs(texts, counts.where(F.col("c") < held.least))
    logs = F.col("logs") + F.coalesce("rare_logs", F.lit(0.0))
    return likely.join(rare, "row", "left").select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("known") + F.coalesce("rare_known", F.lit(0))).alias("n_known"),
        F.lit(held.every).cast("long").alias("train_tokens"),
        (logs - F.col("n_tokens") * float(np.log10(held.every + 0.5 * (held.distinct + 1)))).alias("base_score"),
        (F.col("likely") + logs - F.col("spread")).alias("score"),
    )
