"""Mixing to target weights with soft membership.

A classifier fitted on labelled rows says how likely each document belongs to each
domain. Projected-gradient least squares then finds a rate per document so that the
expected token totals of the domains match their targets.
"""

from __future__ import annotations

import logging
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketflow.llm.common import apart, release, releasing
from marketflow.llm.features import BITS, Hasher, hashed_rows
from marketflow.llm.linear import fit_softmax, softmax
from marketflow.llm.ordinal import sampled_features
from marketflow.llm.spans import LOWER, flat, row_slices
from marketflow.session import settle

#: labelled rows the classifier is fitted on, at most
SAMPLE_ROWS = 12_000
#: rows that the descent of the rates starts on, as many on average (all of fewer)
START_ROWS = 50_000
#: bytes of text whose features are made at a time: a worker holds some fifty times as much
SLICE_BYTES = 1 << 18
#: domains told by the given labels: good prose, toxic text, poor text
DOMAINS = ("prose", "toxic", "poor")
#: largest miss of a domain's share of all tokens; share of the squared misses by which a fit that can't meet them may be off
TOLERANCE, PROVEN = 1e-4, 1e-2

log = logging.getLogger(__name__)


def domain_of_labels() -> Column:
    """The number of the domain in `DOMAINS`, from columns quality and toxic; null if either is."""
    known = F.col("quality").isNotNull() & F.col("toxic").isNotNull()
    return F.when(known, F.when(F.col("toxic") > 0, 1).when(F.col("quality") > 0, 0).otherwise(2)).cast("int")


def _entries(batches: Iterator[pa.RecordBatch]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(row of each entry, feature numbers, values, labels) of rows of `sampled_features`, in their order."""
    counts, numbers, values, label = ([np.empty(0, kind)] for kind in (np.int32, np.int32, np.float64, np.int32))
    for batch in batches:
        held = batch.column("numbers")
        counts.append(np.diff(held.offsets.to_numpy()))
        # copies, so that no batch stays behind them
        numbers.append(held.flatten().to_numpy().copy())
        values.append(batch.column("values").flatten().to_numpy().copy())
        label.append(batch.column("label").to_numpy().copy())
    counts, label = np.concatenate(counts), np.concatenate(label)
    return np.repeat(np.arange(len(label), dtype=np.int32), counts), np.concatenate(numbers), np.concatenate(values), label


def fit_domains(docs: DataFrame, labelled: DataFrame, domains: int, rows: int = SAMPLE_ROWS) -> np.ndarray:
    """Classifier weights from `docs` (doc_id, text) and `labelled` (doc_id, label), on `rows` rows at most.

    Without labels all weights are 0 and the domains equally likely.
    """

    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, numbers, values, label = _entries(batches)
        release()  # of the batches
        if len(label):
            weights = fit_softmax(at, numbers, values, label, domains, 1 << BITS)
            yield pa.RecordBatch.from_pydict({"model": pa.array([weights.ravel()], pa.list_(pa.float64()))})

    # the sample is bounded: one task reads it, in the order of ids
    sample = sampled_features(docs, labelled, rows).coalesce(1).sortWithinPartitions("doc_id")
    made = sample.mapInArrow(releasing(train), "model array<double>").collect()
    size = (1 << BITS) + 1
    return np.array(made[0]["model"]).reshape(size, domains) if made else np.zeros((size, domains))


def _members(batches: Iterator[pa.RecordBatch], weights: np.ndarray) -> Iterator[pa.RecordBatch]:
    domains, hasher = weights.shape[1], Hasher()
    for batch in batches:
        data, offsets = flat(batch.column("text"))
        for first, last in row_slices(offsets, SLICE_BYTES):
            at, numbers, values, tokens = hashed_rows(
                LOWER[data[offsets[first] : offsets[last]]], offsets[first : last + 1] - offsets[first], hasher
            )
            hasher.trim()
            margin = [np.bincount(at, weights[numbers, d] * values, last - first) + weights[-1, d] for d in range(domains)]
            columns = [batch.column(c).slice(first, last - first) for c in ("row", "doc_id")]
            columns += [pa.array(tokens, pa.int64()), *map(pa.array, softmax(np.stack(margin, 1)).T.copy())]
            yield pa.RecordBatch.from_arrays(columns, names=["row", "doc_id", "tokens", *[f"p{d}" for d in range(domains)]])


def memberships(docs: DataFrame, weights: np.ndarray) -> DataFrame:
    """`row`, `doc_id`, `tokens` (words of the whole text) and `p0`, `p1`, ... (they sum to 1) per row of `docs` (row, doc_id, text)."""
    schema = "row long, doc_id long, tokens long, " + ", ".join(f"p{d} double" for d in range(weights.shape[1]))
    given = docs.select("row", F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    return given.mapInArrow(releasing(lambda batches: _members(batches, weights)), schema)


def _sums(p: np.ndarray, weight: np.ndarray, totals: list[np.ndarray], least: float, most: float) -> np.ndarray:
    """A row for each sum of steps: distance of the rates from 1 with their linear part, shares, curvature of free rows and of all."""
    rows = []
    for total in totals:
        pull = p @ total
        rate = np.clip(1 - pull, least, most)
        free = (rate > least) & (rate < most)
        near = weight @ (rate * pull + 0.5 * (rate - 1) ** 2)
        curves = [((p * held_by[:, None]).T @ p).ravel() for held_by in (weight * free, weight)]
        rows.append(np.concatenate([[near], (rate * weight) @ p, *curves]))
    return np.array(rows)


def _descend(
    measured: Callable[[list[np.ndarray]], np.ndarray], goal: np.ndarray, total: np.ndarray, weight: float, widest: float
) -> tuple[np.ndarray, np.ndarray, float, str]:
    """(sum of steps, shares reached, weight left, why it ended), from `total` and `weight` on; `measured` is `_sums` of all rows."""
    domains, even = len(goal), np.eye(len(goal))
    cut = 1 + domains + domains * domains
    parts = lambda g: (g[0], g[1 : 1 + domains], g[1 + domains : cut].reshape(domains, -1), g[cut:].reshape(domains, -1))
    near, at, free, full = parts(measured([total])[0])
    while np.abs(at - goal).max() > TOLERANCE:
        slope = at - goal - weight * total
        value = near - total @ goal - 0.5 * weight * total @ total
        if np.abs(slope).max() <= 0.1 * max(TOLERANCE, np.abs(at - goal).max()):
            left = float(((at - goal) ** 2).sum())
            if weight * widest**2 <= PROVEN * left or weight < 1e-12:
                return total, at, weight, "the bounds keep the shares from their targets"
            weight /= 10
            continue
        scaled, plain = np.linalg.solve(free + weight * even, slope), np.linalg.solve(full + weight * even, slope)
        tries = [total + scaled * part for part in (1.0, 0.5, 0.2, 0.05, 0.01)] + [total + plain * part for part in (1.0, 4.0)]
        tried = [parts(g) for g in measured(tries)]
        gains = [t[0] - x @ goal - 0.5 * weight * x @ x for t, x in zip(tried, tries)]
        best = int(np.argmax(gains))
        if gains[best] <= value:  # what is left is rounding
            return total, at, weight, "the fit ends by rounding"
        total, (near, at, free, full) = tries[best], tried[best]
    return total, at, weight, ""


def fit_rates(
    held: DataFrame, targets: list[float], least: float = 0.0, most: float = 16.0, budget: float | None = None
) -> tuple[np.ndarray, np.ndarray]:
    """The step in the domains that leads to the rates (for `apply_rates`) and the shares of tokens they reach.

    `held`: settled memberships. `targets`: a weight per domain, of sum 1. Minimises the
    squared misses of the expected token totals over rates between `least` and `most`
    by projected gradient: a document's rate is 1 less its memberships times the
    gradient steps summed so far, projected onto the bounds, so no state per document
    travels. A step is scaled by the curvature of the rows whose rates are free to move;
    every pass tries it, parts of it and the plain one, and takes the best. Of all rates that fit,
    those nearest to 1 are found: `w (rate - 1)**2` is added to the misses with a weight
    that falls tenfold each time its optimum is reached. The totals aimed at are `targets`
    times `budget` times all tokens; by default `budget` is 1 or, where rates may not fall
    below 1, just what lets every domain with a positive target reach it without
    shrinking, `most` at most.

    It ends when the targets are met to `TOLERANCE`, or when the weight left is too
    small to hide more than `PROVEN` of the squared misses: then the bounds forbid a better fit,
    which the log tells together with the shares reached. Both are judged on all rows.

    The descent starts where it ends on about `START_ROWS` rows, taken by hash, and goes on
    over all rows: every pass is one aggregation that brings a few numbers per pair of
    domains to the driver. A table without tokens keeps its rates at 1 (within the bounds).
    """
    domains, goal = len(targets), np.array(targets, float) / max(sum(targets), 1e-12)
    columns = [f"p{d}" for d in range(domains)]
    rows, every = held.agg(F.count("*"), F.coalesce(F.sum("tokens"), F.lit(0))).first()
    if not every:
        return np.zeros(domains), np.zeros(domains)
    each = 1 + domains + 2 * domains * domains

    def measured(totals: list[np.ndarray]) -> np.ndarray:
        cells = [f"c{k}" for k in range(len(totals) * each)]

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            sums = np.zeros((len(totals), each))
            for batch in batches:
                sums += _sums(batch[columns].to_numpy(), batch["tokens"].to_numpy() / every, totals, least, most)
            yield pd.DataFrame([sums.ravel()], columns=cells)

        parts = held.select("tokens", *columns).mapInPandas(run, ", ".join(f"{c} double" for c in cells))
        return np.array(parts.agg(*[F.sum(c) for c in cells]).first(), float).reshape(len(totals), each)

    if budget is None:
        present = measured([np.zeros(domains)])[0][1 : 1 + domains]
        budget = 1.0 if least < 1 else min(most, max(1.0, *(s / g for s, g in zip(present, goal) if g > 0)))
    goal, widest = goal * budget, max(most - 1, 1 - least, 0.0)
    total, weight = np.zeros(domains), 1e-2
    chosen = F.pmod(F.xxhash64("row", F.lit(31)), F.lit(1 << 30)) < int((1 << 30) * min(1.0, START_ROWS / rows))
    start = held.where(chosen).select("tokens", *columns).toPandas()
    if start["tokens"].sum():
        p, share = start[columns].to_numpy(), (start["tokens"] / start["tokens"].sum()).to_numpy()
        total, _, weight, _ = _descend(lambda totals: _sums(p, share, totals, least, most), goal, total, weight, widest)
    total, at, _, why = _descend(measured, goal, total, weight, widest)
    if why:
        log.warning("%s: reached %s of %s", why, at.round(5).tolist(), goal.round(5).tolist())
    return total, at


def apply_rates(held: DataFrame, total: np.ndarray, domains: int, least: float = 0.0, most: float = 16.0) -> DataFrame:
    """`held` with `rate` and `copies`: the rate rounded up or down by the hash of `row`, so that it holds on average."""
    pull = sum((F.col(f"p{d}") * float(total[d]) for d in range(domains)), F.lit(0.0))
    rated = held.withColumn("rate", F.greatest(F.lit(float(least)), F.least(F.lit(float(most)), 1 - pull)))
    toss = F.pmod(F.xxhash64("row", F.lit(29)), F.lit(1 << 30)) / F.lit(float(1 << 30))
    return rated.withColumn("copies", F.floor(F.round("rate", 9) + toss).cast("int"))


def rates(
    docs: DataFrame, labelled: DataFrame, targets: list[float], least: float = 0.0, most: float = 16.0
) -> tuple[DataFrame, DataFrame]:
    """(rates, numbered docs): memberships, `rate` and `copies` by `row`, and `docs` with that number, settled.

    `labelled` (doc_id, label) names domains by their place in `targets`. Null and empty
    texts have no tokens and a rate like any other of their memberships. Null and
    repeated ids are kept apart by `row`, which is reserved.
    """
    numbered = settle(docs.withColumn("row", F.monotonically_increasing_id()), "numbered")
    weights = fit_domains(numbered, labelled, len(targets))
    held = settle(memberships(numbered, weights), "memberships")
    total, _ = fit_rates(held, targets, least, most)
    return apply_rates(held, total, len(targets), least, most), numbered


def mix(docs: DataFrame, labelled: DataFrame, targets: list[float], least: float = 1.0, most: float = 4.0) -> DataFrame:
    """`docs` with each row as often as its rate says, all columns as they were.

    With `least` at 1 no row is lost and the targets are met by repeating rows of the
    domains that lack tokens. An upper rate keeps repetition in bounds. Other columns
    than `doc_id` and `text` may have any name: they are renamed in between.
    """
    names = docs.columns
    docs = apart(docs, "doc_id", "text")
    rated, numbered = rates(docs, labelled, targets, least, most)
    often = settle(rated.where("copies <> 1").select("row", "copies"), "copies")
    counted = numbered.join(often, "row", "left")
    times = F.explode(F.sequence(F.lit(1), F.coalesce("copies", F.lit(1))))
    present = F.coalesce("copies", F.lit(1)) > 0
    return counted.where(present).withColumn("__copy", times).select(*docs.columns).toDF(*names)
