"""Toxicity through a noisy channel: restore disguised words, then score the restored text.

A disguised word is a path through a lattice of characters: digits and signs may stand
for letters, signs may be noise, a run of one letter may be one or two, and single
letters in a row may be a word. Viterbi decoding finds the path that a character model of the corpus and
the costs of the channel like best. A word without such characters has one path only,
itself. A logistic model over the restored words and their heads gives the score.
"""

from __future__ import annotations

import re
import string
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketflow.llm.common import WORD, apart, fold, releasing
from marketflow.llm.linear import fit_logistic, sigmoid
from marketflow.session import settle

#: fixed values: what a digit or sign may stand for
READINGS = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "gb", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c", "€": "e", "£": "l",
}
#: costs of the channel in nats: a reading; readable signs as noise inside a word, at its ends, and digits there;
#: other signs as noise; a mark for any letter; a run read as one or two letters; joined single letters
READ, NOISE, EDGE_NOISE, EDGE_DIGIT, SIGN, ANY, ONCE, TWICE, JOIN = 0.7, 12.0, 0.6, 8.0, 0.3, 2.0, 0.5, 1.0, 1.0
LETTERS = 28  # the end of a word, a to z, any other letter
#: decoded tokens and words with known features that a task keeps
WORDS_KEPT, KNOWN_KEPT = 60_000, 100_000
#: texts that are held as strings at a time
TEXTS_HELD = 256
#: longer tokens keep this many readings a position
EXACT, BEAM = 64, 32

#: rows of labels and features of the model, by which the fit is bounded
SAMPLE_ROWS, MODEL_FEATURES = 20_000, 4096
#: a feature is taken if its G statistic reaches this (chance: one in ten thousand features)
LEAST_GAIN = 15.0
THRESHOLD = 0.7


#: signs of ASCII without a reading, which are noise at the ends of a word, and a run of three
SIGNS = "".join(c for c in string.punctuation if c not in READINGS)
RUN = re.compile(r"(.)\1\1")


def _code(letter: str) -> int:
    return ord(letter) - 96 if "a" <= letter <= "z" else 27


def _codes_of(text: str) -> np.ndarray:
    """Letters of a text as codes, 0 between words."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    low = points < 128
    letter = (points >= 97) & (points <= 122)
    return np.where(letter, points - 96, np.where(low, 0, 27)).astype(np.int64)


def _held_texts(batch: pa.RecordBatch) -> Iterator[str | None]:
    """The texts of a batch, `TEXTS_HELD` of them as strings at a time."""
    column = batch.column("text")
    for start in range(0, len(column), TEXTS_HELD):
        yield from column.slice(start, TEXTS_HELD).to_pylist()


def character_counts(texts: DataFrame) -> DataFrame:
    """(`trigram`, `n`): how often each three letter codes follow each other in `text`, over all rows.

    Counted inside a task into one table of 28 cubed cells, summed across tasks.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(LETTERS**3, np.int64)
        for batch in batches:
            for text in _held_texts(batch):
                if text:
                    codes = np.concatenate([[0, 0], _codes_of(text), [0]])
                    total += np.bincount(
                        (codes[:-2] * LETTERS + codes[1:-1]) * LETTERS + codes[2:], minlength=LETTERS**3
                    )
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(held, pa.int64()), pa.array(total[held])], names=["trigram", "n"])

    parts = texts.select(F.col("text").cast("string").alias("text")).mapInArrow(count, "trigram long, n long")
    return parts.groupBy("trigram").agg(F.sum("n").alias("n"))


class CharacterModel:
    """Log probabilities of a letter after two others, smoothed by the shorter contexts."""

    def __init__(self, counts: np.ndarray):
        three = counts.reshape(LETTERS, LETTERS, LETTERS).astype(float)
        one = three.sum((0, 1)) + 1.0
        one /= one.sum()
        two = three.sum(0) + 5.0 * one
        two /= two.sum(1, keepdims=True)
        self.logs = np.log((three + 5.0 * two) / (three + 5.0 * two).sum(2, keepdims=True)).tolist()

    def word(self, letters: str) -> float:
        a = b = 0
        total = 0.0
        for letter in letters:
            c = _code(letter)
            total += self.logs[a][b][c]
            a, b = b, c
        return total + self.logs[a][b][0]

    def arcs(self, token: str, at: int) -> Iterator[tuple[int, str, float]]:
        """(next position, emitted letters, cost) of the lattice at a position."""
        sign = token[at]
        end = at + 1
        while end < len(token) and token[end] == sign:
            end += 1
        edge = at == 0 or end == len(token)
        if sign.isalpha():
            if end - at >= 3:
                yield end, sign, ONCE
                yield end, sign * 2, TWICE
            else:
                yield at + 1, sign, 0.0
            return
        if sign in READINGS:
            for letter in READINGS[sign]:
                yield end, letter, READ + (ONCE if end - at > 2 else 0.0)
                if end - at == 2:
                    yield end, letter * 2, READ
            first = at == 0 and sign in "@$€£"
            yield end, "", EDGE_DIGIT if edge and (sign.isdigit() or first) else EDGE_NOISE if edge else NOISE
            return
        if sign in "*#%?" and not edge and end == at + 1:
            for letter in "abcdefghijklmnopqrstuvwxyz":
                yield end, letter, ANY
            yield end, "", NOISE
        else:
            yield end, "", EDGE_NOISE if edge else SIGN

    def decode(self, token: str, parts: bool = False) -> tuple[str, float]:
        """The best reading of a token and its score; with `parts`, of single letters that may be several words.

        The best way into every (position, last two letters) is kept with the step that
        led there. Tokens of up to `EXACT` signs are decoded exactly, of any more the `BEAM`
        best ways go on from each position, so the work grows with the length alone.
        """
        logs, ways = self.logs, [{} for _ in range(len(token) + 1)]
        ways[0][(0, 0)] = (0.0, None, "")
        for at in range(len(token)):
            here = ways[at]
            if len(token) > EXACT and len(here) > BEAM:
                here = ways[at] = dict(sorted(here.items(), key=lambda w: -w[1][0])[:BEAM])
            for (a, b), (score, _, _) in here.items():
                for end, letters, cost in self.arcs(token, at):
                    x, y, total = a, b, score - cost
                    for letter in letters:
                        c = _code(letter)
                        total += logs[x][y][c]
                        x, y = y, c
                    ahead = ways[end]
                    old = ahead.get((x, y))
                    if old is None or total > old[0]:
                        ahead[(x, y)] = (total, (at, a, b), letters)
                    if parts and y and end < len(token):  # a word may end here
                        total += logs[x][y][0]
                        old = ahead.get((0, 0))
                        if old is None or total > old[0]:
                            ahead[(0, 0)] = (total, (at, a, b), letters + " ")
        last = max(ways[-1].items(), key=lambda w: w[1][0] + logs[w[0][0]][w[0][1]][0])
        (a, b), (score, step, letters) = last
        score, read = score + logs[a][b][0], [letters]
        while step is not None:
            _, step, letters = ways[step[0]][step[1:]]
            read.append(letters)
        return "".join(reversed(read)), score


def _plain(token: str) -> bool:
    """Whether a token has one path only: letters without runs of three."""
    return token.isalpha() and not any(x == y == z for x, y, z in zip(token, token[1:], token[2:]))


class Restorer:
    """Restores the words of texts; keeps a bounded number of decoded tokens."""

    def __init__(self, model: CharacterModel):
        self.model = model
        self.decoded = lru_cache(WORDS_KEPT)(self._token)

    def token(self, token: str) -> str:
        """A token as it is read; plain words are their own reading and need no place among those kept."""
        word = token.lower().strip(SIGNS)
        return word if word.isascii() and word.isalpha() and not RUN.search(word) else self.decoded(token)

    def _token(self, token: str) -> str:
        if token.isascii() is False:
            token = unicodedata.normalize("NFKC", token)
        token = token.lower()
        # signs that have no reading are noise at the ends of a word
        while token and not token[0].isalpha() and token[0] not in READINGS:
            token = token[1:]
        while token and not token[-1].isalpha() and token[-1] not in READINGS:
            token = token[:-1]
        if not token or _plain(token) or not any(c.isalpha() for c in token):
            return token
        return self.model.decode(token)[0]

    def words(self, text: str | None) -> list[str]:
        """The restored words of a whole text."""
        restored, singles = [], []
        for token in WORD.findall(text) if text else []:
            if len(token) == 1 and token.isascii() and (token.isalpha() or token in READINGS):
                singles.append(token.lower())
                continue
            if singles:
                restored += self._joined(singles)
                singles = []
            word = self.token(token)
            if word:
                restored.append(word)
        return restored + self._joined(singles)

    def _joined(self, singles: list[str]) -> list[str]:
        """Single letters in a row, however many: the words they spell if the models like that better."""
        if len(singles) < 3 or not any(c.isalpha() for c in singles):
            return singles
        read, score = self.model.decode("".join(singles), parts=True)
        apart = sum(self.model.word(c) if c.isalpha() else -READ for c in singles)
        return read.split() if score - JOIN > apart else singles


def _features(word: str) -> list[int]:
    """Hashes of a word and of its heads of three to six letters."""
    parts = [f"={word}"] + [f"^{word[:n]}" for n in (3, 4, 5, 6) if len(word) >= n]
    return [xxhash.xxh32_intdigest(p.encode("utf-8", "surrogatepass")) for p in parts]


class ToxicityModel:
    """A character model and weights by feature, small enough to travel with a task."""

    def __init__(self, characters: np.ndarray, weights: dict[int, float], intercept: float):
        self.characters, self.weights, self.intercept = characters, weights, intercept


def fit(docs: DataFrame, labels: DataFrame, folds: int = 3, held_out: int = 1) -> ToxicityModel:
    """Train on `docs` (doc_id, text) and `labels` (doc_id, toxic).

    The character model counts all texts, without labels. Labels are taken from ids whose
    crc32 modulo `folds` is not `held_out`, at most `SAMPLE_ROWS` of them, chosen by the
    hash of the id; a doc_id with several labels counts as toxic if one says so; null ids and
    labels are left out. The features are the `MODEL_FEATURES` that tell the two
    classes apart best in that sample. Without labels of both classes the model gives every
    text the share of toxic labels (0.5 without any).
    """
    counts = np.zeros(LETTERS**3)
    for row in character_counts(docs).collect():  # 28 cubed rows at most
        counts[row["trigram"]] = row["n"]

    chosen = (
        labels.where("doc_id is not null and toxic is not null")
        .where(fold(F.col("doc_id"), folds) != held_out)
        .groupBy("doc_id")
        .agg(F.max("toxic").cast("int").alias("label"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(SAMPLE_ROWS)
    )
    chosen = settle(chosen, "labels")
    sample = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")

    def features(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        restorer = Restorer(CharacterModel(counts))
        for batch in batches:
            for doc_id, text, label in zip(batch["doc_id"], batch["text"], batch["label"]):
                found = {f for word in set(restorer.words(text)) for f in _features(word)}
                yield pd.DataFrame({"doc_id": [doc_id], "label": [label], "features": [np.array(sorted(found), np.int64)]})

    held = settle(
        sample.select("doc_id", "text", "label").mapInPandas(releasing(features), "doc_id long, label int, features array<long>"),
        "features",
    )
    totals = {r["label"]: r["n"] for r in chosen.groupBy("label").agg(F.count("*").alias("n")).collect()}
    bad, good = totals.get(1, 0), totals.get(0, 0)
    if not bad or not good:
        share = bad / (bad + good) if bad + good else 0.5
        return ToxicityModel(counts, {}, float(np.log(max(share, 1e-3) / max(1 - share, 1e-3))))
    by_feature = held.select("label", F.explode("features").alias("feature")).groupBy("feature").agg(
        F.sum("label").alias("in_bad"), F.sum(1 - F.col("label")).alias("in_good")
    )
    # G statistic of the feature against the label: what chance alone would hardly give
    cell = lambda seen, row, column: F.when(seen > 0, seen * F.log(seen * float(bad + good) / (row * column))).otherwise(0.0)
    has = F.col("in_bad") + F.col("in_good")
    lacks = F.lit(bad + good) - has
    gain = 2 * (
        cell(F.col("in_bad"), has, F.lit(bad))
        + cell(F.col("in_good"), has, F.lit(good))
        + cell(bad - F.col("in_bad"), lacks, F.lit(bad))
        + cell(good - F.col("in_good"), lacks, F.lit(good))
    )
    picked = (
        by_feature.where(has < bad + good)
        .withColumn("gain", gain)
        .where(F.col("gain") >= LEAST_GAIN)
        .orderBy(F.desc("gain"), "feature")
        .limit(MODEL_FEATURES)
        .select("feature")
    )
    wanted = np.array(sorted(r["feature"] for r in picked.collect()), np.int64)  # MODEL_FEATURES at most

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield batch.assign(features=[np.intersect1d(f, wanted) for f in batch["features"]])

    # rows that repeat an id are one example; their number is bounded by that of the labels
    rows = held.mapInPandas(cut, held.schema).groupBy("doc_id", "label").agg(
        F.array_distinct(F.flatten(F.collect_list("features"))).alias("has")
    )
    rows = chosen.join(rows.select("doc_id", "has"), "doc_id", "left").orderBy("doc_id")

    def train(frame: pd.DataFrame) -> pd.DataFrame:
        names = np.unique(np.concatenate([np.empty(0, np.int64), *[h for h in frame["has"] if h is not None]]))
        has = [np.searchsorted(names, h) if h is not None else np.empty(0, int) for h in frame["has"]]
        at = np.repeat(np.arange(len(has)), [len(h) for h in has])
        weights, intercept = fit_logistic(
            at, np.concatenate([np.empty(0, int), *has]).astype(int), np.ones(len(at)), frame["label"].to_numpy(float), len(names)
        )
        return pd.DataFrame({"feature": np.append(names, -1), "weight": np.append(weights, intercept)})

    trained = rows.groupBy().applyInPandas(train, "feature long, weight double").collect()
    weights = {r["feature"]: r["weight"] for r in trained}
    return ToxicityModel(counts, {f: w for f, w in weights.items() if f >= 0}, weights.get(-1, 0.0))


def clean(docs: DataFrame, model: ToxicityModel, below: float = THRESHOLD) -> DataFrame:
    """The rows of `docs` that score below a threshold, with all their columns as they were, whatever their names."""
    scored = score(apart(docs, "text"), model)
    return scored.where(F.col("toxicity") < below).drop("toxicity").toDF(*docs.columns)


def score(docs: DataFrame, model: ToxicityModel, restored: bool = False) -> DataFrame:
    """`docs` with `toxicity` (0 to 1) and, if asked for, the `restored` text.

    Whole texts are scored; a null or empty text gets the score of a text without any
    known feature. All columns of `docs` stay; `toxicity` and `restored` are reserved.
    """
    docs = docs.drop("toxicity", "restored")
    schema = T.StructType([*docs.schema.fields, T.StructField("toxicity", T.DoubleType())])
    if restored:
        schema = schema.add("restored", T.StringType())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        restorer = Restorer(CharacterModel(model.characters))
        weights = model.weights

        @lru_cache(KNOWN_KEPT)
        def known(word: str) -> tuple[int, ...]:
            return tuple(f for f in _features(word) if f in weights)

        for batch in batches:
            scores, texts = [], []
            for text in _held_texts(batch):
                words = restorer.words(text)
                found = {f for word in set(words) for f in known(word)}
                scores.append(float(sigmoid(model.intercept + sum(weights[f] for f in sorted(found)))))
                texts.append(" ".join(words) if restored else "")
            batch = batch.append_column("toxicity", pa.array(scores, pa.float64()))
            yield batch.append_column("restored", pa.array(texts, pa.string())) if restored else batch

    return docs.mapInArrow(releasing(run), schema)
