"""Hard-negative mining by segment summaries: bounds of inner products from means and deviations, then exact scores.

Every vector is cut into segments of components. Of each segment only its mean and its
deviation (the length of what is left without the mean) are held. The inner product of
two segments of m components is m times the product of the means, plus or minus at most
the product of the deviations, so sums over the segments bound the score. Segments are
refined from level to level for the vectors that still count; only what the finest level
leaves open is scored exactly.

Segments are cut along the principal axes of a shard, which leaves inner products as
they are: the first axes hold most of a vector's length, so few short segments at the
head bound well. Vectors without any main direction are the worst case: their bounds
close only on the last level.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketflow.session import settle

#: vectors of a shard, and anchors that a task takes through a shard
SHARD_ROWS, ANCHOR_BLOCK = 16_384, 1024
#: anchors whose bounds with a shard are held at once
QUERIES_AT_ONCE = 32
#: share of the leading components that are segments of their own, by level; segments of doubling size follow
LEVELS = (1 / 4, 3 / 4, 7 / 8)
#: bounds are sums of doubles: they are widened by this share of the largest possible score
SLACK = 1e-9


def whole_components(vector: Column) -> Column:
    """floor(256 x) of each component, as double."""
    return F.transform(vector, lambda x: F.floor(256 * x.cast("double")).cast("double"))


def is_whole(vector: Column) -> Column:
    """Whether a vector is there, with no null or non-finite component."""
    part = lambda x: x.cast("double")
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(part(x)) & (F.abs(part(x)) != F.lit(float("inf"))))
    return F.coalesce(vector.isNotNull() & fine, F.lit(False))


def dense(vectors: pd.Series, width: int) -> np.ndarray:
    """Rows of a matrix; a shorter vector ends in zeros."""
    made = np.zeros((len(vectors), width))
    for k, v in enumerate(vectors):
        made[k, : len(v)] = v
    return made


def segment_edges(width: int, share: float) -> np.ndarray:
    """Where the segments of a level begin, and the width."""
    edges = list(range(min(width, max(1, round(share * width))) + 1))
    while edges[-1] < width:
        edges.append(min(width, 2 * edges[-1]))
    return np.array(edges)


def principal_axes(matrix: np.ndarray) -> np.ndarray:
    """Orthonormal axes, those along which the rows are longest first."""
    return np.linalg.eigh(matrix.T @ matrix)[1][:, ::-1]


class Summaries:
    """Means and deviations of the segments of some vectors, level by level."""

    def __init__(self, matrix: np.ndarray, axes: np.ndarray):
        self.matrix = matrix
        self.size = np.sqrt((matrix**2).sum(1))
        self.levels = []
        turned = matrix @ axes
        for share in LEVELS:
            edges = segment_edges(matrix.shape[1], share)
            if len(edges) <= matrix.shape[1]:
                m = np.diff(edges)
                mean = np.add.reduceat(turned, edges[:-1], 1) / m
                rest = np.add.reduceat(turned**2, edges[:-1], 1) - m * mean**2
                # the root of m goes into the mean, so that the products of both are plain
                self.levels.append((mean * np.sqrt(m), np.sqrt(np.maximum(rest, 0.0))))

    def bounds(self, level: int, asked: "Summaries", some: slice, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(least, most) that the scores of some queries with some rows can be."""
        (mean, rest), (q_mean, q_rest) = self.levels[level], asked.levels[level]
        size = self.size
        if len(rows) < len(self.matrix):
            mean, rest, size = mean[rows], rest[rows], size[rows]
        middle = q_mean[some] @ mean.T
        wide = q_rest[some] @ rest.T + np.outer(SLACK * asked.size[some], size) + SLACK
        return middle - wide, middle + wide

    def best(self, asked: "Summaries", some: slice, open_rows: np.ndarray, ties: np.ndarray, k: int, intervals: list) -> tuple[list, int]:
        """For each of some queries and each of its `intervals` (least, most): the k highest scores inside.

        `open_rows`: which rows each query may find. Returns (rows, scores) per query and
        interval, and how many scores were taken exactly. On each level a row is closed
        for a query if its bounds miss every interval, or fall short of k rows that are
        certain to lie inside. Equal scores stay in and are decided by `ties`.
        """
        floors = [[least for least, _ in own] for own in intervals]
        for level in range(len(self.levels)):
            rows = np.flatnonzero(open_rows.any(0))
            low, high = self.bounds(level, asked, some, rows)
            for q, own in enumerate(intervals):
                here = np.flatnonzero(open_rows[q, rows])
                least, most, keep = low[q, here], high[q, here], np.zeros(len(here), bool)
                for i, (_, end) in enumerate(own):
                    sure = least[(least >= floors[q][i]) & (most <= end)]
                    if len(sure) >= k:
                        floors[q][i] = max(floors[q][i], float(np.partition(sure, len(sure) - k)[len(sure) - k]))
                    keep |= (most >= floors[q][i]) & (least <= end)
                open_rows[q, rows[here[~keep]]] = False
        found, scored = [], 0
        for q, own in enumerate(intervals):
            rows = np.flatnonzero(open_rows[q])
            scores = self.matrix[rows] @ asked.matrix[some][q]
            scored += len(rows)
            found.append([])
            for least, most in own:
                inside = (scores >= least) & (scores <= most)
                held, got = rows[inside], scores[inside]
                if len(held) > k:
                    good = got >= np.partition(got, len(got) - k)[len(got) - k]
                    held, got = held[good], got[good]
                order = np.lexsort((ties[held], -got))[:k]
                found[-1].append((held[order], got[order]))
        return found, scored


def _dealt(queries: DataFrame, vectors: DataFrame, shards: int, blocks: int) -> tuple:
    """Both sides keyed by (shard, block): each query meets each shard, in bounded groups."""
    deal = lambda n, c: F.pmod(F.xxhash64(c), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = queries.withColumn("block", deal(blocks, "anchor_row")).withColumn("shard", every(shards))
    right = vectors.withColumn("shard", deal(shards, "row")).withColumn("block", every(blocks))
    return left.groupBy("shard", "block"), right.groupBy("shard", "block")


def _summaries(vectors: pd.Series, queries: pd.Series, width: int) -> tuple[Summaries, Summaries]:
    """Of a shard and of its queries, both along the shard's axes."""
    matrix = dense(vectors, width)
    axes = principal_axes(matrix)
    return Summaries(matrix, axes), Summaries(dense(queries, width), axes)


def _ids(frame: pd.DataFrame) -> np.ndarray:
    """Ids for ties; null ids come last."""
    return frame["vec_id"].fillna(np.iinfo(np.int64).max).to_numpy(np.int64)


def mine(
    vectors: DataFrame, is_anchor: Column, positives: int = 5, negatives: int = 10, least: float = 0.3, most: float = 0.9
) -> DataFrame:
    """Hard negatives of each anchor and positive.

    `vectors`: vec_id long, label int, v array<double> of whole numbers (sums of products
    are exact below 2**53). Anchors are the rows for which `is_anchor` holds. An anchor's
    positives are its `positives` best other rows of the same label, by inner product,
    ties to the smaller vec_id; its negatives for a positive are the `negatives` best
    rows of other labels whose score is at least `least` and at most `most` times the
    positive's, both taken in hundredths. Fewer are returned where there are fewer; a
    pair without any negative has no row.

    Rows with a null label or vector take no part. Rows are told apart as rows: one that
    repeats an anchor's vec_id is another row, and each of repeated anchors is answered.
    Rows with a null vec_id are never anchors, and come last among ties. A vector
    shorter than others counts as ending in zeros. An empty table gives no rows.

    Columns: anchor_id, positive_id, rank, negative_id, positive_score, negative_score.
    """
    low, high = round(100 * least), round(100 * most)
    rows = vectors.where("label is not null and v is not null").select(
        "vec_id", "label", "v", F.coalesce(is_anchor, F.lit(False)).alias("anchor"), F.monotonically_increasing_id().alias("row")
    )
    rows = settle(rows, "vectors")
    held = rows.select("row", "vec_id", "label", "v")
    anchors = rows.where("anchor and vec_id is not null").select(
        F.col("row").alias("anchor_row"), F.col("vec_id").alias("anchor_id"), F.col("label").alias("anchor_label"), F.col("v").alias("q")
    )
    counted = rows.agg(F.count("*").alias("n"), F.count_if("anchor").alias("anchors"), F.max(F.size("v")).alias("width")).first()
    width = max(1, counted["width"] or 1)
    shards = max(1, -(-counted["n"] // SHARD_ROWS), min(-(-counted["n"] // 1024), rows.sparkSession.sparkContext.defaultParallelism))
    blocks = max(1, -(-counted["anchors"] // ANCHOR_BLOCK))

    def searched(asked: pd.DataFrame, given: pd.DataFrame, same: bool, k: int, intervals: list) -> Iterator[tuple]:
        """(query, interval, rows, scores) of a shard; queries of one label go together."""
        shard, queries = _summaries(given["v"], asked["q"], width)
        labels, numbers, ties = given["label"].to_numpy(), given["row"].to_numpy(), _ids(given)
        for first in range(0, len(asked), QUERIES_AT_ONCE):
            some = slice(first, min(first + QUERIES_AT_ONCE, len(asked)))
            label, own = (asked[c].to_numpy()[some, None] for c in ("anchor_label", "anchor_row"))
            open_rows = (labels == label) & (numbers != own) if same else labels != label
            found, _ = shard.best(queries, some, open_rows, ties, k, intervals[some])
            for q, by_interval in enumerate(found, first):
                for i, (rows, scores) in enumerate(by_interval):
                    yield q, i, given["row"].to_numpy()[rows], given["vec_id"].iloc[rows].to_numpy(), scores

    def near(asked: pd.DataFrame, given: pd.DataFrame) -> pd.DataFrame:
        """The shard's best rows of each anchor's label."""
        found = [pd.DataFrame({"anchor_row": [], "row": [], "vec_id": [], "score": []})]
        if len(asked) and len(given):
            asked = asked.sort_values("anchor_label")
            for q, _, row, vec_id, scores in searched(asked, given, True, positives, [[(-np.inf, np.inf)]] * len(asked)):
                found.append(pd.DataFrame({"anchor_row": asked["anchor_row"].iloc[q], "row": row, "vec_id": vec_id, "score": scores}))
        return pd.concat(found[1:] or found)

    left, right = _dealt(anchors, held, shards, blocks)
    hits = settle(left.cogroup(right).applyInPandas(near, "anchor_row long, row long, vec_id long, score double"), "near")
    by_anchor = Window.partitionBy("anchor_row").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"), "row")
    best = hits.withColumn("place", F.row_number().over(by_anchor)).where(F.col("place") <= positives)
    wanted = best.groupBy("anchor_row").agg(F.sort_array(F.collect_list(F.struct("place", "vec_id", "score"))).alias("positives"))
    wanted = settle(anchors.join(wanted, "anchor_row").select("anchor_row", "anchor_label", "q", F.col("positives.place").alias("place"), F.col("positives.score").alias("score")), "wanted")

    def far(asked: pd.DataFrame, given: pd.DataFrame) -> pd.DataFrame:
        """The shard's best rows of other labels inside each positive's interval."""
        found = [pd.DataFrame({"anchor_row": [], "place": [], "row": [], "vec_id": [], "score": []})]
        if len(asked) and len(given):
            asked = asked.sort_values("anchor_label")
            # whole scores: the interval's ends are the nearest whole numbers inside
            ends = [[(float(-(-low * int(s) // 100)), float(high * int(s) // 100)) for s in scores] for scores in asked["score"]]
            for q, i, row, vec_id, scores in searched(asked, given, False, negatives, ends):
                place = asked["place"].iloc[q][i]
                found.append(pd.DataFrame({"anchor_row": asked["anchor_row"].iloc[q], "place": place, "row": row, "vec_id": vec_id, "score": scores}))
        return pd.concat(found[1:] or found)

    left, right = _dealt(wanted, held, shards, blocks)
    hits = settle(left.cogroup(right).applyInPandas(far, "anchor_row long, place int, row long, vec_id long, score double"), "far")
    by_pair = Window.partitionBy("anchor_row", "place").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"), "row")
    hard = hits.withColumn("rank", F.row_number().over(by_pair)).where(F.col("rank") <= negatives)
    pairs = best.select("anchor_row", "place", F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"))
    ids = anchors.select("anchor_row", "anchor_id")
    return hard.join(pairs, ["anchor_row", "place"]).join(ids, "anchor_row").select(
        "anchor_id",
        "positive_id",
        "rank",
        F.col("vec_id").alias("negative_id"),
        F.col("positive_score").cast("long").alias("positive_score"),
        F.col("score").cast("long").alias("negative_score"),
    )
