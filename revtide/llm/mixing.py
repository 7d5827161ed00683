"""Mixing sources to target weights by temperature.

A source's weight is its share of the tokens raised to an exponent between 0
and 1.  The exponent is the largest that meets the target: entropy at least
``least_entropy`` of the possible, and no source repeated beyond
``most_repeats``.  The weights are then realised exactly: every source is read
in seeded permutations, one after the other, until its budget is spent, and the
stream is cut into blocks that each hold every source's share.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from revtide.llm.common import quoted, row_hash, stored

SEED = 20240607
#: Entropy of the weights, as a share of that of equal weights.
LEAST_ENTROPY = 0.95
#: No source is read more often than this, on average.
MOST_REPEATS = 4.0
#: Tokens of a block of the mixed stream.
BLOCK_TOKENS = 1 << 20
#: Rows of a slice of a permutation, about; a slice is ordered in one task.
SLICE_ROWS = 4096


def words(column: str) -> Column:
    """Words of a text, the measure of its tokens; 0 for null."""
    count = F.regexp_count(F.col(column).cast("string"), F.lit(r"[^\x20\x09-\x0D]+"))
    return F.coalesce(count, F.lit(0)).cast("long")


def weights_at(exponent: float, tokens: Sequence[int]) -> list[float]:
    total = sum(tokens)
    powers = [(t / total) ** exponent if t else 0.0 for t in tokens]
    scale = math.fsum(powers)
    return [p / scale for p in powers]


def entropy(weights: Sequence[float]) -> float:
    return -math.fsum(w * math.log(w) for w in weights if w > 0)


def _boundary(holds: Callable[[float], bool]) -> float:
    """Last point, from the end of 0 to 1 at which the property holds, where it still does."""
    low, high = 0.0, 1.0
    at_low = holds(low)
    for _ in range(60):
        middle = (low + high) / 2
        if holds(middle) == at_low:
            low = middle
        else:
            high = middle
    return low if at_low else high


def fit_exponent(
    tokens: Sequence[int], budget: int, least_entropy: float = LEAST_ENTROPY, most_repeats: float = MOST_REPEATS
) -> float:
    """The exponent, by bisection.

    Lower exponents even the weights out, which raises the entropy, and the
    repetition of small sources.  The repetition limit goes first: where it
    forbids the entropy asked for, the lowest exponent it allows is taken.  A
    budget that no exponent can serve within the limit leaves the limit aside.
    """
    live = [t for t in tokens if t]
    if len(live) < 2:
        return 1.0

    def even_enough(x: float) -> bool:
        return entropy(weights_at(x, live)) >= least_entropy * math.log(len(live)) - 1e-12

    def repeats_allowed(x: float) -> bool:
        return all(w * budget <= most_repeats * t * (1 + 1e-12) for w, t in zip(weights_at(x, live), live, strict=True))

    exponent = 1.0 if even_enough(1.0) else _boundary(even_enough)
    if repeats_allowed(1.0) and not repeats_allowed(exponent):
        exponent = _boundary(repeats_allowed)
    return exponent


def source_weights(
    lengths: DataFrame,
    budget: int | None = None,
    least_entropy: float = LEAST_ENTROPY,
    most_repeats: float = MOST_REPEATS,
) -> DataFrame:
    """``source_key, rows, source_tokens, weight, quota`` from ``source_key, tokens``.

    The driver sees one row per source, for the bisection.  ``quota`` is the
    source's part of the budget, which defaults to all tokens there are.  A
    source without tokens has weight 0.
    """
    sums = lengths.groupBy("source_key").agg(F.count(F.lit(1)).alias("rows"), F.sum("tokens").alias("tokens"))
    rows = sorted(sums.collect())
    tokens = [r["tokens"] for r in rows]
    total = sum(tokens) if budget is None else budget
    weights = [0.0] * len(rows)
    if sum(tokens):
        weights = weights_at(fit_exponent(tokens, total, least_entropy, most_repeats), tokens)
    made = [(*r, w, round(w * total)) for r, w in zip(rows, weights, strict=True)]
    return lengths.sparkSession.createDataFrame(
        made, "source_key string, rows long, source_tokens long, weight double, quota long"
    )


def _up_to_here(keys: Sequence[str], order: Sequence[str]):
    return Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)


def _with_positions(copies: DataFrame) -> DataFrame:
    """Adds ``first_token``: tokens of the copies before this one in its source's stream.

    A permutation is a hash order whose slices have a bounded number of rows.
    Slices are summed first, so no task orders a whole source.
    """
    keys = ["source_key", "copy", "slice"]
    sums = copies.groupBy(*keys).agg(F.sum("tokens").alias("slice_tokens"))
    # A source has its rows / SLICE_ROWS slices here.
    before = F.sum("slice_tokens").over(_up_to_here(["source_key"], ["copy", "slice"])) - F.col("slice_tokens")
    offsets = sums.select(*keys, before.alias("slice_first"))
    within = F.sum("tokens").over(_up_to_here(keys, ["order", "row", "repeat"])) - F.col("tokens")
    return (
        copies.withColumn("within", within)
        .join(offsets, keys)
        .withColumn("first_token", F.col("slice_first") + F.col("within"))
    )


def mix(
    documents: DataFrame,
    budget: int | None = None,
    least_entropy: float = LEAST_ENTROPY,
    most_repeats: float = MOST_REPEATS,
    block_tokens: int = BLOCK_TOKENS,
    seed: int = SEED,
    slice_rows: int = SLICE_ROWS,
) -> DataFrame:
    """The mixed stream, one row per copy of a document.

    ``doc_id, source, tokens, copy, first_token, block, place`` and ``row,
    repeat``, which tell rows apart.  ``copy`` numbers the copies of a document
    from 0, ``block`` is the block of the stream it belongs to, and ``place``
    orders a block at random.  The copies of a source are those that start
    before its quota is spent: it exceeds the quota by less than one document,
    and its documents' numbers of copies differ by one at most.

    Null sources form a source of their own.  Rows without words (null or empty
    texts) cost nothing and appear once, in block 0.  Rows that repeat count as
    documents of their own.  An empty table gives an empty stream.
    """
    source_key = F.coalesce(F.concat(F.lit("s"), F.col("source").cast("string")), F.lit("null"))
    rows = documents.select(
        row_hash(documents).alias("row"),
        F.col("doc_id").cast("long").alias("doc_id"),
        source_key.alias("source_key"),
        words("text").alias("tokens"),
    )
    alike = rows.groupBy("row", "doc_id", "source_key", "tokens").agg(F.count(F.lit(1)).alias("n"))
    each = F.explode(F.sequence(F.lit(1).cast("long"), "n")).alias("repeat")
    known = stored(alike.select("row", "doc_id", "source_key", "tokens", each), "lengths")
    weights = stored(source_weights(known, budget, least_entropy, most_repeats), "weights")

    rounds = F.greatest(F.ceil(F.col("quota") / F.col("source_tokens")).cast("long"), F.lit(1).cast("long"))
    copies = (
        known.filter("tokens > 0")
        .join(weights, "source_key")
        .withColumn("copy", F.explode(F.sequence(F.lit(0).cast("long"), rounds - 1)))
        .withColumn("order", F.xxhash64(F.lit(seed), "copy", "row", "repeat"))
        .withColumn("slice", F.pmod("order", F.ceil(F.col("rows") / slice_rows).cast("long")))
    )
    spent = _with_positions(copies).filter("first_token < quota")
    share = F.greatest(F.col("weight") * block_tokens, F.lit(1.0))
    spent = spent.withColumn("block", F.floor(F.col("first_token") / share).cast("long"))
    none = F.lit(0).cast("long")
    free = known.filter("tokens = 0").withColumns({"copy": none, "first_token": none, "block": none})
    columns = ["doc_id", "source_key", "tokens", "copy", "first_token", "block", "row", "repeat"]
    both = spent.select(*columns).union(free.select(*columns))
    source = F.when(F.col("source_key") != "null", F.expr("substring(source_key, 2)"))
    return both.select(
        "doc_id", source.alias("source"), "tokens", "copy", "first_token", "block",
        F.xxhash64(F.lit(seed + 1), "copy", "row", "repeat").alias("place"), "row", "repeat",
    )


def mixed_documents(documents: DataFrame, **options) -> DataFrame:
    """The documents of the stream, each as often as it is drawn, columns as they are."""
    names = quoted(documents.columns)
    drawn = mix(documents, **options).groupBy("row").agg(F.count(F.lit(1)).alias("_drawn"))
    # Rows of one hash are alike in everything, so one of them stands for all.
    one_each = documents.withColumn("_row", row_hash(documents)).dropDuplicates(["_row"])
    joined = one_each.join(drawn.withColumnRenamed("row", "_row"), "_row")
    return joined.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), "_drawn"))).select(
        *names
    )
