"""Quality rules: word and line statistics of a text, and line frequency across documents.

A line that very many documents of a host share is furniture, not text.  Lines
are normalised and hashed, the distinct texts that hold each are counted per
host, and lines above the host's limit are taken out.  A document that loses
more than a stated share of its words that way is depleted and rejected.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from revtide.llm.common import column_values, quoted, small_batches, stored, utf8, with_columns

SYMBOLS = "#*$%&|<>"
SPACES = " \t\n\x0b\x0c\r"
WINDOW = 3
LEAST_WORDS = 50
MOST_REPEATED_PERCENT = 50
#: A line is over the limit of its host if more distinct texts than this share
#: of the host's, and than the floor, have it.
LINE_SHARE = 0.05
LINE_FLOOR = 20
#: A document is depleted if lines over the limit hold more of its words.
DEPLETED_PERCENT = 50


def repeat_words(words: list[bytes]) -> int:
    """Words that stand in a window of three that occurs at least twice."""
    n = len(words) - WINDOW + 1
    if n < 2:
        return 0
    number: dict[bytes, int] = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, len(words))
    key = ids[:n]
    for k in range(1, WINDOW):
        if len(number) * int(key.max() + 1) >= 1 << 62:
            key = np.unique(key, return_inverse=True)[1]
        key = key * len(number) + ids[k : n + k]
    _, group, size = np.unique(key, return_inverse=True, return_counts=True)
    again = size[group] > 1
    inside = np.zeros(len(words), bool)
    for k in range(WINDOW):
        inside[k : n + k] |= again
    return int(inside.sum())


def line_hash(line: bytes) -> tuple[int, int]:
    """Hash of the line in lower case with single spaces, and its words."""
    words = line.lower().split()
    return xxhash.xxh64_intdigest(b" ".join(words)) - (1 << 63), len(words)


def profile(text: bytes | None) -> tuple[int, int, int, int, int, dict[int, int]]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words; words by line hash."""
    text = text or b""
    words = text.split()
    string = text.decode("utf-8", "replace")
    chars = len(string) - sum(string.count(c) for c in SPACES)
    symbols = sum(text.count(c.encode()) for c in SYMBOLS)
    lines: Counter[int] = Counter()
    alike = Counter(line for line in text.split(b"\n") if line and not line.isspace())
    for line, times in alike.items():
        key, n = line_hash(line)
        lines[key] += n * times
    return len(words), chars, symbols, alike.total() - len(alike), repeat_words(words), lines


_LINES = pa.list_(pa.struct([("line", pa.int64()), ("words", pa.int64())]))


def _profile_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    for batch in batches:
        rows = [profile(t) for t in column_values(batch, "text")]
        new = {name: pa.array([r[k] for r in rows], pa.int64()) for k, name in enumerate(names)}
        new["lines"] = pa.array([[{"line": h, "words": n} for h, n in r[5].items()] for r in rows], _LINES)
        yield with_columns(batch, ["doc_id", "host", "text_hash"], new)


def profiles(documents: DataFrame, host: str = "source") -> DataFrame:
    """One row of statistics for every row; a null text has none of anything."""
    small_batches(documents.sparkSession)
    rows = documents.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col(host).cast("string"), F.lit("")).alias("host"),
        F.xxhash64(F.col("text").cast("string")).alias("text_hash"),
        utf8("text").alias("text"),
    )
    return rows.mapInArrow(
        _profile_batches,
        "doc_id long, host string, text_hash long, n_words long, word_chars long, n_symbols long, "
        "n_dup_lines long, n_repeat_words long, lines array<struct<line: long, words: long>>",
    )


def lines_over_limit(lines: DataFrame, share: float = LINE_SHARE, floor: int = LINE_FLOOR) -> DataFrame:
    """``host, line, texts``: lines in more distinct texts of a host than its limit.

    ``lines`` has one row per host, text and line.
    """
    texts = lines.select("host", "text_hash").distinct().groupBy("host").agg(F.count(F.lit(1)).alias("host_texts"))
    counted = lines.groupBy("host", "line").agg(F.count(F.lit(1)).alias("texts"))
    limit = F.greatest(F.lit(floor).cast("double"), F.col("host_texts") * share)
    return counted.filter(F.col("texts") > floor).join(texts, "host").filter(F.col("texts") > limit).select(
        "host", "line", "texts"
    )


def quality(
    documents: DataFrame,
    host: str = "source",
    share: float = LINE_SHARE,
    floor: int = LINE_FLOOR,
    depleted_percent: int = DEPLETED_PERCENT,
) -> DataFrame:
    """Statistics and verdict for every row of ``documents``.

    ``base_failed``: fewer than 50 words, or over half of them in repeated
    windows.  ``kept`` is false for those and for depleted documents.
    ``over_lines`` has the hashes of the document's lines over the limit.

    Equal texts of a host count once, so copies of a document do not condemn
    its lines.  A null host is the empty host.  Null and empty texts have no
    words and fail.  Repeated rows each get their row, an empty table none.
    """
    rows = stored(profiles(documents, host), "profiles")
    exploded = rows.select("host", "text_hash", F.explode("lines").alias("at")).select("host", "text_hash", "at.*")
    lines = stored(exploded.distinct(), "lines")
    over = lines_over_limit(lines, share, floor)
    lost = lines.join(over, ["host", "line"]).groupBy("host", "text_hash").agg(
        F.sum("words").alias("removed_words"), F.sort_array(F.collect_set("line")).alias("over_lines")
    )
    judged = rows.drop("lines").join(lost, ["host", "text_hash"], "left").withColumn(
        "removed_words", F.coalesce("removed_words", F.lit(0).cast("long"))
    )
    failed = (F.col("n_words") < LEAST_WORDS) | (
        F.col("n_repeat_words") * 100 > F.col("n_words") * MOST_REPEATED_PERCENT
    )
    depleted = F.col("removed_words") * 100 > F.col("n_words") * depleted_percent
    return judged.withColumn("base_failed", failed).withColumn("kept", ~failed & ~depleted)


@F.pandas_udf(T.StringType())
def without_lines(texts: pd.Series, over: pd.Series) -> pd.Series:
    """Each text without the lines whose hashes are named."""

    def cleaned(text: bytes, hashes) -> str:
        gone = set(hashes)
        lines = (line for line in text.split(b"\n") if not line.strip() or line_hash(line)[0] not in gone)
        return b"\n".join(lines).decode("utf-8", "replace")

    return pd.Series([cleaned(t, h) for t, h in zip(texts, over, strict=True)])


def kept_documents(documents: DataFrame, host: str = "source", **limits) -> DataFrame:
    """The documents that the rules keep, without their lines over the limit.

    Columns stay as they are; ``n_chars``, where there is one, follows the text.
    """
    names = quoted(documents.columns)
    verdicts = quality(documents, host, **limits).filter("kept").select(
        F.col("host").alias("_kept_host"), F.col("text_hash").alias("_kept_text"), F.col("over_lines").alias("_over")
    ).dropDuplicates(["_kept_host", "_kept_text"])
    marked = documents.withColumn("_kept_host", F.coalesce(F.col(host).cast("string"), F.lit(""))).withColumn(
        "_kept_text", F.xxhash64(F.col("text").cast("string"))
    )
    joined = marked.join(verdicts, ["_kept_host", "_kept_text"])
    touched = F.col("_over").isNotNull()
    untouched = joined.filter(~touched).select(*names)
    changed = joined.filter(touched).withColumn("text", without_lines(utf8("text"), F.col("_over")))
    if "n_chars" in documents.columns:
        changed = changed.withColumn("n_chars", F.length("text").cast(documents.schema["n_chars"].dataType))
    return untouched.union(changed.select(*names))
