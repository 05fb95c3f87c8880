"""Exact top-k search by inner product over weighted terms: MaxScore per shard, then a merge."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketflow.llm.resampling import ranked
from marketflow.session import settle

#: documents of a shard, and queries that a task takes through a shard at once
SHARD_DOCS, QUERY_BLOCK = 8192, 4096
#: queries whose scores with a whole shard are held at once
QUERY_BATCH = 64
HIT_SCHEMA = "query_id long, doc_id long, score double"


def signed_terms(vector: Column) -> list[Column]:
    """A dense document vector as `terms` and `weights`: dimension i is term 2 i if positive, 2 i + 1 if negative."""
    return [
        F.transform(vector, lambda x, i: F.when(x >= 0, 2 * i).otherwise(2 * i + 1).cast("int")).alias("terms"),
        F.transform(vector, lambda x: x.cast("double")).alias("weights"),
    ]


def query_terms(vector: Column) -> list[Column]:
    """A dense query vector as `terms` and `weights`: both terms of each dimension, so that one of them bounds at 0."""
    return [
        F.flatten(F.transform(vector, lambda x, i: F.array((2 * i).cast("int"), (2 * i + 1).cast("int")))).alias("terms"),
        F.flatten(F.transform(vector, lambda x: F.array(x.cast("double"), x.cast("double")))).alias("weights"),
    ]


class Shard:
    """Postings of some documents by term, with the largest and smallest weight of each term.

    The postings of a term that a good part of the documents holds are laid out as a
    column of a matrix with a row a document, so that several such terms are traversed,
    or probed for some documents, as one product.
    """

    DENSE = 1 / 8
    #: columns whose bounds sum to less than this share of the threshold are left to probing
    PROBED = 1 / 8
    #: bounds and sums of doubles may be off by this share of the largest possible sum
    SLACK = 1e-9

    def __init__(self, ids: np.ndarray, docs: np.ndarray, terms: np.ndarray, weights: np.ndarray):
        """`docs` holds positions in `ids`, which must be sorted; a weight of 0 is no posting."""
        self.ids = ids
        docs, terms, weights = docs[weights != 0], terms[weights != 0], weights[weights != 0]
        order = np.lexsort((docs, terms))
        docs, terms, weights = docs[order], terms[order], weights[order]
        self.terms, starts = np.unique(terms, return_index=True)
        ends = np.append(starts[1:], len(terms))
        self.most, self.least = np.zeros(len(starts)), np.zeros(len(starts))
        self.column = np.full(len(starts), -1)
        self.postings, columns = [], []
        for place, (a, b) in enumerate(zip(starts, ends)):
            self.postings.append((docs[a:b], weights[a:b]))
            self.most[place], self.least[place] = weights[a:b].max(initial=0.0), weights[a:b].min(initial=0.0)
            if b - a >= self.DENSE * len(ids):
                self.column[place] = len(columns)
                column = np.zeros(len(ids))
                column[docs[a:b]] = weights[a:b]
                columns.append(column)
        self.matrix = np.array(columns).reshape(len(columns), len(ids)).T.copy()

    def _products(self, some: np.ndarray, places: np.ndarray, weights: np.ndarray) -> np.ndarray:
        """What terms laid out as columns add to some documents."""
        wanted = np.zeros(self.matrix.shape[1])
        wanted[self.column[places]] = weights
        return self.matrix[some] @ wanted

    def _probe(self, some: np.ndarray, place: int, weight: float) -> np.ndarray:
        """What a term kept as a list adds to some documents (sorted positions)."""
        docs, values = self.postings[place]
        at = np.minimum(np.searchsorted(docs, some), len(docs) - 1)
        return np.where(docs[at] == some, weight * values[at], 0.0)

    def top(self, query: list[tuple[int, float]], k: int, own: int | None) -> tuple[np.ndarray, np.ndarray]:
        """The k best documents of one query, see `tops`."""
        terms, weights = zip(*query) if query else ((), ())
        return next(self.tops([(np.array(terms, np.int64), np.array(weights, float))], k, [own]))

    def tops(
        self, queries: list[tuple[np.ndarray, np.ndarray]], k: int, owns: list[int | None]
    ) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Per query (terms, weights) the k best documents other than its `own`: (positions, scores), ties to smaller ids.

        A term's bound is the most it can add; absent terms add 0. With the terms in the
        order of rising bounds, those whose bounds sum to less than the k-th best score
        so far are non-essential: a document without any other term can't get in. The
        essential postings are traversed, those laid out as columns for `QUERY_BATCH`
        queries by one product. It also takes the columns of bound 0, which only lower
        scores, and the higher of the non-essential ones, so that few documents stay
        open: only for those that can still reach the threshold the other terms are
        probed, columns first. Equal scores stay in, so the ties are decided by id at the end.
        """
        for first in range(0, len(queries), QUERY_BATCH):
            plans = [self._plan(*query, k, own) for query, own in zip(queries[first : first + QUERY_BATCH], owns[first:])]
            taken = np.zeros((len(plans), self.matrix.shape[1]))
            for row, (places, weights, _, _, _, product, _) in enumerate(plans):
                taken[row, self.column[places[product]]] = weights[product]
            scores = taken @ self.matrix.T
            for row, plan in enumerate(plans):
                yield self._best(scores[row], k, *plan)

    def _plan(self, terms: np.ndarray, weights: np.ndarray, k: int, own: int | None) -> tuple:
        """What `_best` needs of a query.

        Places of the held terms by rising bounds, their weights and bounds, the threshold,
        the number of non-essential terms, which terms the product takes, and the own positions.
        """
        places = np.minimum(np.searchsorted(self.terms, terms), len(self.terms) - 1) if len(self.terms) else terms[:0]
        held = self.terms[places] == terms[: len(places)]
        places, weights = places[held], weights[: len(held)][held]
        most, least = weights * self.most[places], weights * self.least[places]
        bounds = np.maximum(np.maximum(most, least), 0.0)
        order = np.argsort(bounds, kind="stable")
        places, weights, bounds = places[order], weights[order], bounds[order]
        mine = slice(*np.searchsorted(self.ids, [own, own + 1])) if own is not None else slice(0, 0)
        threshold = self._seed(places, weights, k, mine) - self.SLACK * np.maximum(np.abs(most), np.abs(least)).sum()
        # the longest head of the list whose bounds sum to less than the threshold
        cut = int(np.searchsorted(np.cumsum(bounds), threshold, side="left")) if threshold > 0 else 0
        product = (self.column[places] >= 0) & ((np.cumsum(bounds) >= self.PROBED * threshold) | (bounds == 0))
        return places, weights, bounds, threshold, cut, product, mine

    def _best(
        self,
        scores: np.ndarray,
        k: int,
        places: np.ndarray,
        weights: np.ndarray,
        bounds: np.ndarray,
        threshold: float,
        cut: int,
        product: np.ndarray,
        mine: slice,
    ) -> tuple[np.ndarray, np.ndarray]:
        """The k best, from `scores` by the product."""
        touched = np.full(len(self.ids), threshold <= 0 or product[cut:].any())
        for i in cut + np.flatnonzero(~product[cut:]):
            docs, values = self.postings[places[i]]
            scores[docs] += weights[i] * values
            touched[docs] = True
        touched[mine] = False
        rest = np.flatnonzero(touched & (scores + bounds[:cut][~product[:cut]].sum() >= threshold))
        scores = scores[rest]
        columns = np.flatnonzero((self.column[places[:cut]] >= 0) & ~product[:cut])
        if len(columns):
            scores = scores + self._products(rest, places[columns], weights[columns])
        lists = np.flatnonzero(self.column[places[:cut]] < 0)
        for i, left in zip(lists[::-1], np.cumsum(bounds[lists])[::-1]):
            reach = scores + left >= threshold
            rest, scores = rest[reach], scores[reach]
            scores = scores + self._probe(rest, places[i], weights[i])
        if len(rest) > k:
            reach = scores >= np.partition(scores, len(rest) - k)[len(rest) - k]
            rest, scores = rest[reach], scores[reach]
        best = np.lexsort((self.ids[rest], -scores))[:k]
        return rest[best], scores[best]

    def _seed(self, places: np.ndarray, weights: np.ndarray, k: int, mine: slice) -> float:
        """A first threshold: the k-th best full score among documents high in the best list; -inf if fewer."""
        if not len(places):
            return -np.inf
        docs, values = self.postings[places[-1]]
        if mine.stop > mine.start:
            other = (docs < mine.start) | (docs >= mine.stop)
            docs, values = docs[other], values[other]
        if len(docs) < k:
            return -np.inf
        take = min(len(docs), 8 * k)
        some = np.sort(docs[np.argpartition(-weights[-1] * values, take - 1)[:take]])
        columns = self.column[places] >= 0
        scores = self._products(some, places[columns], weights[columns])
        for i in np.flatnonzero(~columns):
            scores += self._probe(some, places[i], weights[i])
        return float(np.partition(scores, take - k)[take - k])


def _flat(frame: pd.DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(ids, positions, terms, weights) of rows of term arrays, in the order of ids."""
    frame = frame.sort_values("id", kind="stable")
    counts = [len(t) for t in frame["terms"]]
    terms = np.concatenate([np.empty(0, np.int64), *frame["terms"]]).astype(np.int64)
    weights = np.concatenate([np.empty(0), *frame["weights"]]).astype(float)
    return frame["id"].to_numpy(), np.repeat(np.arange(len(frame)), counts), terms, weights


def top_k(queries: DataFrame, docs: DataFrame, k: int, skip_same_id: bool = False) -> DataFrame:
    """The k documents of largest inner product for each query: query_id, rank, doc_id, score.

    `queries` (query_id, terms, weights) and `docs` (doc_id, terms, weights): arrays of
    ints and of doubles, side by side, each term once in a row. All documents count, those that
    share no term with a query at score 0; with fewer than k documents all are returned.
    Ties go to the smaller doc_id. Repeated doc_ids are results of their own, and a
    repeated query_id is answered once (by its smallest terms). Rows with null ids or null terms take no part.
    `skip_same_id`: a query never finds the documents with its own id.

    Shards of `SHARD_DOCS` documents meet blocks of `QUERY_BLOCK` queries, one pair a
    task: both sides of a group are bounded. Scores are sums of doubles, exact for
    integer weights below 2**53; the shards' k best are merged by rank.
    """
    whole = "id is not null and terms is not null and weights is not null"
    docs = docs.select(F.col("doc_id").alias("id"), "terms", "weights").where(whole)
    queries = queries.select(F.col("query_id").alias("id"), "terms", "weights").where(whole)
    queries = queries.groupBy("id").agg(F.min(F.struct("terms", "weights")).alias("q")).select("id", "q.*")
    docs, queries = settle(docs, "docs"), settle(queries, "queries")
    shards, blocks = max(1, -(-docs.count() // SHARD_DOCS)), max(1, -(-queries.count() // QUERY_BLOCK))
    deal = lambda n: F.pmod(F.xxhash64("id", "weights"), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = queries.select("id", "terms", "weights", deal(blocks).alias("block")).select("*", every(shards).alias("shard"))
    right = docs.select("id", "terms", "weights", deal(shards).alias("shard")).select("*", every(blocks).alias("block"))

    def search(asked: pd.DataFrame, held: pd.DataFrame) -> pd.DataFrame:
        if asked.empty or held.empty:
            return pd.DataFrame({"query_id": [], "doc_id": [], "score": []})
        shard, ids = Shard(*_flat(held)), asked["id"].to_numpy()
        owns = ids.tolist() if skip_same_id else [None] * len(ids)
        best, scores = zip(*shard.tops(list(zip(asked["terms"], asked["weights"])), k, owns))
        counts = [len(some) for some in best]
        return pd.DataFrame(
            {"query_id": np.repeat(ids, counts), "doc_id": shard.ids[np.concatenate(best)], "score": np.concatenate(scores)}
        )

    hits = (
        left.groupBy("shard", "block").cogroup(right.groupBy("shard", "block")).applyInPandas(search, HIT_SCHEMA)
    )
    by_query = Window.partitionBy("query_id").orderBy(F.desc("score"), "doc_id")
    return (
        settle(hits, "hits")
        .withColumn("rank", F.row_number().over(by_query))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "doc_id", "score")
    )


def top_k_rows(vectors: DataFrame, is_query: Column, k: int) -> DataFrame:
    """The k best other rows of each row for which `is_query` holds: query_id, rank, vec_id, score.

    `vectors`: vec_id, v (dense). Rows are numbered in the order of vec_id (nulls last)
    and searched by that number, so a row that repeats an id is a row of its own, as
    query and as result, one with a null id is found too, and only the query's own row is left out.
    """
    numbered = ranked(vectors.select("vec_id", "v"), [F.asc_nulls_last("vec_id"), F.asc("v")], "vectors")
    found = top_k(
        numbered.where(is_query).select(F.col("rank").alias("query_id"), *query_terms(F.col("v"))),
        numbered.select(F.col("rank").alias("doc_id"), *signed_terms(F.col("v"))),
        k,
        skip_same_id=True,
    )
    found = settle(found, "found")
    named = lambda number, name: numbered.select(F.col("rank").alias(number), F.col("vec_id").alias(name))
    return found.withColumnsRenamed({"query_id": "q", "doc_id": "d"}).join(named("q", "query_id"), "q").join(
        named("d", "vec_id"), "d"
    ).select("query_id", "rank", "vec_id", "score")
