"""Benchmark questions in documents, also with other numbers, names and units.

Numbers, names and units become typed placeholders, which turns a question into
a template.  Windows of template tokens are hashed and joined.  Where windows of
a document and a template line up, the values in the placeholders are compared:
a value of the question must stand for one value of the document throughout.  A
re-parameterised question passes, a chance mixture of values does not.

Windows of mostly placeholders, and questions of fewer than five tokens, say too
little as templates.  They are joined as they stand, with their values and the
signs between them.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revtide.llm.common import column_values, quoted, small_batches, stored, utf8

WINDOW = 8
#: Shorter questions are no templates; only their literal text is searched.
LEAST_TOKENS = 5
#: A question counts as present if aligned windows cover this share of its
#: tokens, or this many tokens.
COVERED_SHARE = 0.5
COVERED_TOKENS = 13
#: Bits of a window's hash that address the filter, whose size is thus fixed.
FILTER_BITS = 22
#: Entries of a worker's token memory.
MEMORY = 400_000

UNITS = frozenset(
    "mm cm m km inch inches foot feet ft yard yards mile miles g kg mg gram grams kilogram kilograms lb lbs pound "
    "pounds ounce ounces oz ton tons l ml liter liters litre litres gallon gallons second seconds sec minute minutes "
    "min hour hours hr day days week weeks month months year years dollar dollars usd euro euros eur cent cents "
    "percent mph kmh degree degrees celsius fahrenheit watt watts kw volt volts joule joules kb mb gb tb".split()
)
NUMBER_WORDS = frozenset(
    "zero one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen "
    "eighteen nineteen twenty thirty forty fifty sixty seventy eighty ninety hundred thousand million billion".split()
)
_NUMBER = re.compile(r"[+-]?[0-9][0-9.,/:]*(%|st|nd|rd|th|[a-z]{1,2})?")
_EDGES = re.compile(r"^[\W_]+|[\W_]+$")
_MIX = np.uint64(0x9E3779B97F4A7C15)


def _hash(token: str) -> int:
    return xxhash.xxh64_intdigest(token.encode("utf-8", "surrogatepass")) | 1


_PLACEHOLDER = {kind: _hash(f"<{kind}>") for kind in ("number", "unit", "name")}


class Canonical:
    """Texts as template tokens; remembers the tokens it has met."""

    def __init__(self) -> None:
        self.clear()

    def clear(self) -> None:
        self.number: dict[str, int] = {}
        self.hashes = np.zeros(1 << 12, np.uint64)
        self.values = np.zeros(1 << 12, np.uint64)
        self.signs = np.zeros(1 << 12, np.uint64)
        self.capital = np.zeros(1 << 12, bool)
        self.ends = np.zeros(1 << 12, bool)

    def _add(self, raw: str) -> int:
        """Hash (0: no token), value of a placeholder (0: none), capitalised, ends a sentence."""
        core = _EDGES.sub("", raw)
        low = core.lower()
        if not core:
            row = (0, 0, False)
        elif low in NUMBER_WORDS or _NUMBER.fullmatch(low):
            row = (_PLACEHOLDER["number"], _hash(low), False)
        elif low in UNITS:
            row = (_PLACEHOLDER["unit"], _hash(low), False)
        else:
            row = (_hash(low), 0, core[0].isupper() and core[1:].islower())
        self.number[raw] = place = len(self.number)
        if place == len(self.hashes):
            for name in ("hashes", "values", "signs", "capital", "ends"):
                setattr(self, name, np.concatenate([getattr(self, name)] * 2))
        self.hashes[place], self.values[place], self.capital[place] = row
        self.signs[place] = 0 if core else _hash(raw)
        self.ends[place] = raw.rstrip("\"')]»”’")[-1:] in (".", "?", "!", ":")
        return place

    def tokens(self, text: bytes | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Token hashes, values of the placeholders (0 elsewhere), and the signs before each token.

        A capitalised word is a name unless it starts a sentence.  Words without
        a letter or digit are no tokens but signs.
        """
        raw = (text or b"").decode("utf-8", "replace").split()
        known, add = self.number.get, self._add
        places = [known(word) for word in raw]
        if None in places:
            places = [add(word) if (k := known(word)) is None else k for word in raw]
        at = np.array(places, np.int64)
        tokens, values, signs = self.hashes[at], self.values[at], self.signs[at]
        starts = np.concatenate(([True], self.ends[at[:-1]])) if len(at) else np.zeros(0, bool)
        names = self.capital[at] & ~starts
        values = np.where(names, tokens, values)
        tokens = np.where(names, np.uint64(_PLACEHOLDER["name"]), tokens)
        if len(self.number) > MEMORY:
            self.clear()
        real = tokens != 0
        signs = np.diff(np.cumsum(signs, dtype=np.uint64)[real], prepend=np.uint64(0))
        return tokens[real], values[real], signs


@cache
def _canonical() -> Canonical:
    """A worker's token memory, which its later tasks find again."""
    return Canonical()


def window_hashes(tokens: np.ndarray, size: int) -> np.ndarray:
    n = len(tokens) - size + 1
    if n < 1:
        return np.zeros(0, np.uint64)
    out = np.full(n, size, np.uint64)
    for k in range(size):
        out = (out ^ tokens[k : n + k]) * _MIX
        out ^= out >> np.uint64(29)
    return out


def literal_hashes(tokens: np.ndarray, values: np.ndarray, signs: np.ndarray, size: int) -> np.ndarray:
    """Hashes of windows as they stand: values in their places, signs between tokens."""
    n = len(tokens) - size + 1
    if n < 1:
        return np.zeros(0, np.uint64)
    bare = np.where(values != 0, values, tokens)
    out = np.full(n, ~np.uint64(size), np.uint64)
    for k in range(size):
        token = bare[k : n + k] ^ (signs[k : n + k] * _MIX) if k else bare[:n]
        out = (out ^ token) * _MIX
        out ^= out >> np.uint64(29)
    return out


def _wordy(values: np.ndarray, size: int) -> np.ndarray:
    """Windows of which at least half the tokens are plain words."""
    plain = np.concatenate(([0], np.cumsum(values == 0)))
    return 2 * (plain[size:] - plain[:-size]) >= size


def _marked(hashes: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    return wanted[(hashes >> np.uint64(64 - FILTER_BITS)).astype(np.int64)]


def _windows(tokens: np.ndarray, values: np.ndarray, size: int, wanted: np.ndarray | None):
    """Start, hash and placeholder values of each window that counts as a template."""
    hashes = window_hashes(tokens, size)
    if not len(hashes):
        return
    good = _wordy(values, size)
    if wanted is not None:
        good &= _marked(hashes, wanted)
    for at in np.flatnonzero(good).tolist():
        inside = values[at : at + size]
        yield at, int(hashes[at].view(np.int64)), inside[inside != 0].view(np.int64).tolist()


def _literal_windows(tokens, values, signs, size: int, wanted: np.ndarray | None):
    """Start, hash and no values: of a question the windows that are no templates, of a document all that are wanted."""
    hashes = literal_hashes(tokens, values, signs, size)
    if not len(hashes):
        return
    if wanted is not None:
        good = _marked(hashes, wanted)
    else:
        good = ~_wordy(values, size) | (size < LEAST_TOKENS)
    for at in np.flatnonzero(good).tolist():
        yield at, int(hashes[at].view(np.int64)), []


def _template_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    canonical = _canonical()
    for batch in batches:
        rows = []
        for item, text in zip(column_values(batch, "item_id"), column_values(batch, "text"), strict=True):
            tokens, values, signs = canonical.tokens(text)
            if not len(tokens):
                continue
            size = min(WINDOW, len(tokens))
            short = size < LEAST_TOKENS
            # A short question is its literal text.
            key = xxhash.xxh64_intdigest((literal_hashes(tokens, values, signs, size) if short else tokens).tobytes())
            vector = xxhash.xxh64_intdigest(values.tobytes() + signs[1:].tobytes())
            item_row = {
                "item_id": item, "template": key - (1 << 63), "vector": vector - (1 << 63), "n_tokens": len(tokens), "size": size,
            }
            both = (
                (False, () if short else _windows(tokens, values, size, None)),
                (True, _literal_windows(tokens, values, signs, size, None)),
            )
            rows += [
                item_row | {"literal": literal, "at": a, "hash": h, "values": v}
                for literal, windows in both
                for a, h, v in windows
            ]
        yield pa.RecordBatch.from_pylist(rows, _TEMPLATE)


_TEMPLATE = pa.schema(
    [
        *((name, pa.int64()) for name in ("item_id", "template", "vector", "n_tokens", "size", "at", "hash")),
        ("literal", pa.bool_()),
        ("values", pa.list_(pa.int64())),
    ]
)
_HIT = pa.schema([*((name, pa.int64()) for name in ("doc_id", "text_hash", "at", "hash")), ("values", pa.list_(pa.int64()))])


def template_windows(benchmark: DataFrame) -> DataFrame:
    """Windows of the questions, ``template, vector, item_id, named, n_tokens, size, at, hash, literal, values``.

    Questions with the same template are one, named by the smallest item_id;
    every distinct vector of values that they put into it stays, and ``named``
    marks the one of the named question.
    """
    rows = benchmark.filter("item_id IS NOT NULL").select(
        F.col("item_id").cast("long").alias("item_id"), utf8("text").alias("text")
    )
    ddl = (
        "item_id long, template long, vector long, n_tokens long, size long, at long, hash long, literal boolean, "
        "`values` array<long>"
    )
    windows = stored(rows.mapInArrow(_template_batches, ddl), "windows")
    first = windows.groupBy("template").agg(
        F.min("item_id").alias("item_id"), F.min_by("vector", F.struct("item_id", "vector")).alias("named_vector")
    )
    distinct = windows.drop("item_id").distinct().join(first, "template")
    return distinct.withColumn("named", F.col("vector") == F.col("named_vector")).drop("named_vector")


def _hit_batches(shared, sizes: list[tuple[int, bool]]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = np.unpackbits(np.frombuffer(shared.value, np.uint8)).astype(bool)
        canonical = _canonical()
        for batch in batches:
            rows = []
            columns = (column_values(batch, name) for name in ("doc_id", "text_hash", "text"))
            for doc, key, text in zip(*columns, strict=True):
                tokens, values, signs = canonical.tokens(text)
                for size, literal in sizes:
                    windows = (
                        _literal_windows(tokens, values, signs, size, wanted)
                        if literal
                        else _windows(tokens, values, size, wanted)
                    )
                    rows += [{"doc_id": doc, "text_hash": key, "at": a, "hash": h, "values": v} for a, h, v in windows]
            yield pa.RecordBatch.from_pylist(rows, _HIT)

    return run


def leaks(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``doc_id, item_id, covered, n_tokens, same_values`` per document and question found in it.

    ``covered`` counts the question's tokens in windows that line up.  Questions
    with one template are reported under the smallest item_id, whichever of them
    has the values that agree; ``same_values`` tells a literal copy of that named
    question from others.  Questions under five tokens, down to one word, and
    windows of mostly numbers, names and units are found as literal text only.  Null and empty
    texts and questions hold nothing; rows with a null doc_id are reported with
    it, and rows that repeat doc_id and text once.  Either table may be empty.
    """
    spark = documents.sparkSession
    small_batches(spark)
    templates = stored(template_windows(benchmark), "templates")
    # Sizes 5 to 8 of templates, 1 to 8 of literal windows.
    sizes = [tuple(row) for row in templates.select("size", "literal").distinct().collect()]
    # At most 2^22 addresses, whatever the benchmark.
    marks = templates.select(F.shiftrightunsigned("hash", 64 - FILTER_BITS).alias("k")).distinct().toPandas().k
    wanted = np.zeros(1 << FILTER_BITS, bool)
    wanted[marks.to_numpy(np.int64)] = True
    shared = spark.sparkContext.broadcast(np.packbits(wanted).tobytes())

    rows = documents.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.xxhash64(F.col("text").cast("string")).alias("text_hash"),
        utf8("text").alias("text"),
    )
    ddl = "doc_id long, text_hash long, at long, hash long, `values` array<long>"
    hits = rows.mapInArrow(_hit_batches(shared, sorted(sizes)), ddl)
    item = ["template", "vector", "item_id", "named", "n_tokens", "size"]
    theirs = templates.select(*item, "hash", F.col("at").alias("item_at"), F.col("values").alias("item_values"))
    met = hits.join(theirs, "hash").filter(F.size("values") == F.size("item_values"))
    lined_up = met.groupBy("doc_id", "text_hash", *item, (F.col("at") - F.col("item_at")).alias("shift")).agg(
        F.collect_set("item_at").alias("starts"),
        F.array_distinct(F.flatten(F.collect_set(F.arrays_zip("item_values", "values")))).alias("pairs"),
    )
    one_each = F.size("pairs") == F.size(F.array_distinct(F.col("pairs.item_values")))
    same = F.col("named") & ~F.exists("pairs", lambda p: p["item_values"] != p["values"])
    found = lined_up.filter(one_each).groupBy("doc_id", "text_hash", *item).agg(
        F.sort_array(F.array_distinct(F.flatten(F.collect_list("starts")))).alias("starts"),
        F.bool_or(same).alias("same_values"),
    )
    # Starts ascend: each adds what it does not share with the next.
    steps = F.expr(
        "aggregate(sequence(1, size(starts)), 0L, (sum, i) -> sum + "
        "if(i = size(starts), size, least(size, starts[i] - starts[i - 1])))"
    )
    covered = found.withColumn("covered", steps)
    enough = (F.col("covered") >= COVERED_TOKENS) | (F.col("covered") >= F.col("n_tokens") * COVERED_SHARE)
    # A template is there if the values of any of its questions agree.
    return covered.filter(enough).groupBy("doc_id", "text_hash", "template", "item_id", "n_tokens").agg(
        F.max("covered").alias("covered"), F.bool_or("same_values").alias("same_values")
    ).select("doc_id", "text_hash", "item_id", "covered", "n_tokens", "same_values")


def clean_documents(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents in which no question is found, columns as they are.

    Rows without a doc_id are judged by their text alone.
    """
    names = quoted(documents.columns)
    found = leaks(documents, benchmark).select(
        F.coalesce("doc_id", F.lit(-1)).alias("_leak_id"), F.col("text_hash").alias("_leak_text")
    ).distinct()
    marked = documents.withColumn("_leak_id", F.coalesce(F.col("doc_id").cast("long"), F.lit(-1))).withColumn(
        "_leak_text", F.xxhash64(F.col("text").cast("string"))
    )
    return marked.join(found, ["_leak_id", "_leak_text"], "left_anti").select(*names)
