"""Small tables and plain restatements of the contracts."""

import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
# Columns with the names of results.
CLASHING = {"fp": "1", "host": "2", "shard": "3", "block": "4", "component_id": "5", "tokens": "6", "value": "7"}


def documents(spark, rows):
    """Rows of ``doc_id, text`` and, if given, ``lang, source``."""
    full = [(r[0], r[1], *(r[2:] or ("en", "s1")), None if r[1] is None else len(r[1])) for r in rows]
    return spark.createDataFrame(full, SCHEMA)


def awkward(spark):
    """Nulls anywhere, empty and blank texts, repeated rows, a very long text, ties."""
    long = " ".join(f"word{i % 977}" for i in range(60_000))
    rows = [
        (1, None), (2, ""), (3, " \n\t "), (4, "one"), (4, "one"), (4, "two words"), (None, "no id here"),
        (5, long), (6, long), (7, "same text of several words"), (8, "same text of several words"),
        (9, "nul \x00 and   and é́ \U0001f600"), (10, "x" * 100_000), (11, "no lang", None, None),
    ]
    frame = documents(spark, rows)
    for name, value in CLASHING.items():
        from pyspark.sql import functions as F

        frame = frame.withColumn(name, F.lit(value))
    return frame


def words(text):
    return WORD.findall(text or "")
