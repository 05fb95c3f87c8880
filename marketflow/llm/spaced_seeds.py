"""Benchmark decontamination by spaced-seed hashing, in DataFrame functions only.

Fixed masks pick token positions; the hash of the picked tokens is joined between the
test items and every position of the training texts, so a token that a mask ignores may
have been replaced. Each hit names an alignment, which is then verified token by token.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketflow.llm.common import apart, broadcast_if_small, text_key
from marketflow.session import settle

#: fixed values: any 13 aligned tokens with at most 2 replaced ones hold one of these masks untouched
MASKS = ((0, 1, 2, 4, 6, 7), (0, 1, 3, 6, 7, 8))
#: tokens of an aligned window, and how many of them must be equal (0.8 of it, rounded up)
WINDOW, AGREE = 13, 11
#: rows of seeds (24 bytes each) and of items that may be broadcast; beyond it the join is a shuffle
BROADCAST_ROWS = 1_000_000

#: items of fewer tokens convict a text only if a caller asks for them, as the query and the pipeline do
LEAST_TOKENS = 5

NOT_A_TOKEN = r"[^\p{L}\p{M}\p{N}]+"


def token_hashes(text: Column) -> Column:
    """One long per token: the runs of letters, marks and digits in lower case."""
    tokens = F.split(F.lower(F.coalesce(text, F.lit(""))), NOT_A_TOKEN)
    return F.transform(F.filter(tokens, lambda t: t != ""), lambda t: F.xxhash64(t))


def _seeded(rows: DataFrame, hashes: str, lengths: list[int]) -> DataFrame:
    """A row per position (`__at`) and mask that fits there, with `__seed`; other columns stay.

    `lengths`: token counts of short items, which are matched as a whole. The mask's
    number is hashed too, so a seed is one long.
    """
    picks = [*MASKS, *[tuple(range(n)) for n in lengths]]
    turns = F.sequence(F.lit(0), F.size(hashes) * len(picks) - 1)
    exploded = rows.where(F.size(hashes) > 0).select("*", F.explode(turns).alias("__turn"))
    at = F.floor(F.col("__turn") / F.lit(len(picks))).cast("int")
    exploded = exploded.select("*", at.alias("__at"), (F.col("__turn") % len(picks)).alias("__mask"))
    room = F.size(hashes) - F.col("__at")
    seed = F.lit(None).cast("long")
    for k, pick in enumerate(picks):
        value = F.xxhash64(F.lit(pick[-1] if k >= len(MASKS) else -k), *[F.get(hashes, F.col("__at") + p) for p in pick])
        seed = F.when((F.col("__mask") == k) & (room > pick[-1]), value).otherwise(seed)
    return exploded.select("*", seed.alias("__seed")).where(F.col("__seed").isNotNull()).drop("__turn")


def _agreeing_window(equal: Column, window: int, agree: int) -> Column:
    """Whether some `window` neighbours among the 0/1 flags hold at least `agree` ones.

    Between two zeros with exactly `window - agree` zeros inside lies the longest
    stretch with that many replaced tokens; both ends of the flags count as zeros.
    """
    spare = window - agree
    zeros = F.array_compact(F.transform(equal, lambda e, i: F.when(e == 0, i)))
    walls = F.concat(F.array(F.lit(-1)), zeros, F.array(F.size(equal)))
    whole = (F.size(zeros) <= spare) & (F.size(equal) >= window)
    stretch = F.exists(
        F.sequence(F.lit(0), F.size(walls) - spare - 2),
        lambda i: F.get(walls, i + spare + 1) - F.get(walls, i) - 1 >= window,
    )
    return whole | ((F.size(zeros) > spare) & stretch)


def contaminations(docs: DataFrame, tests: DataFrame, id_column: str = "doc_id", least_tokens: int = LEAST_TOKENS) -> DataFrame:
    """One row per training id and test item that overlap, with the best alignment.

    Tokens are runs of letters, marks and digits in lower case. A text overlaps an item
    of 13 tokens or more if some 13 aligned neighbours have at least 11 equal tokens,
    replaced tokens included; the two masks find every such window. An item of fewer
    tokens must occur whole. Items without tokens, or with less than `least_tokens` (1 takes
    all), and null and empty texts overlap with nothing. Repeated rows share the row of their id, and rows with a null id that of
    null; items that share an `item_id` count as variants of one.

    Columns: `id_column`, `item_id`, `matched` (equal tokens of the alignment, the most
    of any), `item_tokens`, `at_token` (where the item's first token falls in the text,
    negative if the text starts inside the item; the smallest of equally good ones).

    Texts are read once and stay where they are: the seeds of the items are broadcast if
    there are at most `BROADCAST_ROWS`. Beyond that the seeds are joined by a shuffle,
    and what travels with a seed is at most two item lengths of token hashes.
    """
    items = settle(
        tests.select(
            "item_id", token_hashes(F.col("text")).alias("__item"), F.monotonically_increasing_id().alias("__number")
        ).where(F.size("__item") >= max(least_tokens, 1)),
        "items",
    )
    counts = items.select(F.size("__item").alias("n"))
    longest = counts.agg(F.max("n")).first()[0] or 1
    short = counts.where(F.col("n") < WINDOW).distinct().orderBy("n").collect()  # 12 values at most
    lengths = [row["n"] for row in short]

    whole = F.col("__mask") >= len(MASKS)
    fits = F.size("__item") == F.get(F.array(*[F.lit(n) for n in lengths]), F.col("__mask") - len(MASKS)) if lengths else F.lit(False)
    placed = settle(
        _seeded(items, "__item", lengths)
        .where(F.when(F.size("__item") >= WINDOW, ~whole).otherwise(whole & fits))
        .select("__seed", "__number", F.col("__at").alias("__item_at")),
        "seeds",
    )

    texts = docs.select(F.col(id_column).alias("__id"), token_hashes(F.col("text")).alias("__hashes"))
    near = F.greatest(F.col("__at") - longest, F.lit(0))
    hits = _seeded(texts, "__hashes", lengths).select(
        "__id", "__seed", "__at", near.alias("__from"), F.slice("__hashes", near + 1, 2 * longest).alias("__near")
    )
    shift = F.col("__at") - F.col("__item_at")
    begin = F.greatest(shift, F.lit(0))
    aligned = (
        hits.join(broadcast_if_small(placed, BROADCAST_ROWS), "__seed")
        .join(broadcast_if_small(items, BROADCAST_ROWS // 10), "__number")
        .select(
            "__id",
            "item_id",
            F.size("__item").alias("item_tokens"),
            shift.alias("at_token"),
            # an alignment that starts before the text leaves out the item's first tokens
            F.slice("__near", begin - F.col("__from") + 1, F.size("__item") - begin + shift).alias("__here"),
            F.slice("__item", begin - shift + 1, F.size("__item")).alias("__there"),
        )
    )
    # windows lie inside both: what the text lacks at its end is no replaced token
    shared = F.least(F.size("__here"), F.size("__there"))
    flags = F.zip_with(
        F.slice("__here", F.lit(1), shared), F.slice("__there", F.lit(1), shared), lambda a, b: F.when(a == b, 1).otherwise(0)
    )
    flagged = aligned.select("__id", "item_id", "item_tokens", "at_token", flags.alias("__equal")).select(
        "*", F.aggregate("__equal", F.lit(0), lambda s, e: s + e).alias("matched")
    )
    overlaps = F.when(
        F.col("item_tokens") >= WINDOW, _agreeing_window(F.col("__equal"), WINDOW, AGREE)
    ).otherwise(F.col("matched") == F.col("item_tokens"))
    best = F.max(
        F.struct("matched", (-F.col("at_token")).alias("place"), "item_tokens")
    )
    return (
        flagged.where(overlaps)
        .groupBy("__id", "item_id")
        .agg(best.alias("__best"))
        .select(
            F.col("__id").alias(id_column),
            "item_id",
            "__best.matched",
            "__best.item_tokens",
            (-F.col("__best.place")).alias("at_token"),
        )
    )


def decontaminate(docs: DataFrame, tests: DataFrame, least_tokens: int = LEAST_TOKENS) -> DataFrame:
    """The rows of `docs` whose text overlaps with no test item, all columns as they were.

    Rows are told apart by their text, so null and repeated ids are no trouble; equal
    texts go or stay together. No column but `text` is looked at; the others may have any name.
    """
    names, docs = docs.columns, apart(docs, "text")
    keyed = docs.withColumn("__key", text_key(F.col("text")))
    found = contaminations(keyed.select("__key", "text"), tests, "__key", least_tokens)
    leaks = settle(found.select("__key").distinct(), "leaks")
    return keyed.join(broadcast_if_small(leaks, BROADCAST_ROWS), "__key", "left_anti").select(*docs.columns).toDF(*names)
