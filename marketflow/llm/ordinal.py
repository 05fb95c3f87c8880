"""Quality by ordinal regression: cumulative links over hashed text, fitted on graded ratings."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketflow.llm.common import releasing
from marketflow.llm.features import BITS, Hasher, hashed
from marketflow.llm.linear import fit_ordinal, sigmoid
from marketflow.session import settle

#: rated rows the model is fitted on, at most
SAMPLE_ROWS = 12_000
#: texts whose features are held at a time
TEXTS_HELD = 256
#: a text is selected if it reaches the middle grade with this probability
SELECT_AT = 0.5


@dataclass
class OrdinalModel:
    """Weights by feature number and rising thresholds; 2**16 numbers."""

    weights: np.ndarray
    cuts: np.ndarray

    @property
    def grades(self) -> int:
        return len(self.cuts) + 1


def grades_of_labels() -> Column:
    """Ratings from the given labels: 0 poor, 1 good prose that is toxic, 2 good prose; none if either label is null."""
    graded = F.when(F.col("quality") > 0, F.when(F.col("toxic") > 0, 1).otherwise(2)).otherwise(0)
    return F.when(F.col("quality").isNotNull() & F.col("toxic").isNotNull(), graded).cast("int")


def sampled_features(docs: DataFrame, rated: DataFrame, rows: int) -> DataFrame:
    """(`label`, `numbers`, `values`) of at most `rows` rated documents, chosen by the hash of their id.

    `rated` (doc_id, label): null ids and labels are left out, and of several labels of
    an id the smallest counts. The chosen ids are broadcast; their number is bounded.
    """
    chosen = settle(
        rated.where("doc_id is not null and label is not null")
        .groupBy("doc_id")
        .agg(F.min("label").alias("label"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(rows),
        "rated",
    )

    def make(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hasher = Hasher()
        for batch in batches:
            for start in range(0, len(batch), TEXTS_HELD):
                part = batch.iloc[start : start + TEXTS_HELD]
                made = [hashed(text, hasher) for text in part["text"]]
                hasher.trim()
                yield pd.DataFrame(
                    {
                        "doc_id": part["doc_id"],
                        "label": part["label"],
                        "numbers": [m[0].astype(np.int32) for m in made],
                        "values": [m[1] for m in made],
                    }
                )

    sample = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    made = sample.mapInPandas(releasing(make), "doc_id long, label int, numbers array<int>, values array<double>")
    # repeated rows of one id may exceed the bound again
    return settle(made, "features").orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)


def entries(frame: pd.DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(row of each entry, feature numbers, values, labels), in the order of ids."""
    frame = frame.sort_values("doc_id", kind="stable")
    at = np.repeat(np.arange(len(frame)), [len(n) for n in frame["numbers"]])
    return at, np.concatenate(frame["numbers"].tolist(), dtype=np.int64), np.concatenate(frame["values"].tolist()), frame["label"].to_numpy(int)


def fit(docs: DataFrame, rated: DataFrame, grades: int, rows: int = SAMPLE_ROWS) -> OrdinalModel:
    """Fit on `docs` (doc_id, text) and `rated` (doc_id, label from 0 to `grades` - 1), on `rows` rows at most.

    Without any rated row all weights are 0 and the grades equally likely.
    """

    def train(frame: pd.DataFrame) -> pd.DataFrame:
        at, numbers, values, label = entries(frame)
        weights, cuts = fit_ordinal(at, numbers, values, np.clip(label, 0, grades - 1), grades, 1 << BITS)
        return pd.DataFrame({"model": [np.concatenate([weights, cuts])]})

    made = sampled_features(docs, rated, rows).groupBy().applyInPandas(train, "model array<double>").collect()
    if not made:
        even = np.arange(1, grades) / grades
        return OrdinalModel(np.zeros(1 << BITS), np.log(even / (1 - even)))
    model = np.array(made[0]["model"])
    return OrdinalModel(model[: 1 << BITS], model[1 << BITS :])


def grade(docs: DataFrame, model: OrdinalModel) -> DataFrame:
    """`docs` (doc_id, text) as doc_id, `expected_grade`, `tails` and `kept`.

    `tails` holds P(grade >= 1), P(grade >= 2) and so on; `expected_grade` is their sum.
    `kept` tells whether P(grade >= 1) is at least `SELECT_AT`. Whole texts are graded; null
    and empty texts by the features of a text without words.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hasher = Hasher()
        for batch in batches:
            tails = []
            for text in batch["text"]:
                numbers, values = hashed(text, hasher)
                tails.append(sigmoid(model.weights[numbers] @ values - model.cuts))
            hasher.trim()
            yield pd.DataFrame(
                {
                    "doc_id": batch["doc_id"],
                    "expected_grade": [float(t.sum()) for t in tails],
                    "tails": tails,
                    "kept": [bool(t[0] >= SELECT_AT) for t in tails],
                }
            )

    return docs.select("doc_id", "text").mapInPandas(
        run, "doc_id long, expected_grade double, tails array<double>, kept boolean"
    )
