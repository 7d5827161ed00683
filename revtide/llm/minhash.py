"""Near copies by fast similarity sketches, banding and exact verification.

A sketch has ``BINS`` coordinates.  In each round every shingle is hashed into
one bin, and a bin that no earlier round has filled keeps the least hash; after
``BINS`` rounds the remaining bins are filled one a round, with all shingles.
So every coordinate is filled, after few rounds for most texts, two sets agree
in a coordinate with the probability of their Jaccard similarity, and the
number of coordinates in which they agree is as concentrated as that of
independent samples.

Equal shingle sets are one set from the start.  Sets that agree in a whole band
of coordinates are candidates, and links are confirmed on the whole sets.
Neighbours in a bucket are confirmed first, which joins groups of many copies at
a few pairs a text; then every pair of a bucket that still lies in two different
components is looked at, in the first bucket it shares.  Counts of the shingles by
cell bound the overlap of such a pair from above.  A first pass finds the members
that have a pair within the bound, the second gets their texts and confirms the
pairs where they meet.  What leaves a task is a row a member, never a row a pair.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from revtide.llm.common import column_values, small_batches, stored, utf8, with_columns
from revtide.llm.components import connected_components

SHINGLE = 4
#: Sets are near copies from this Jaccard similarity on, in percent.
SIMILAR_PERCENT = 80
#: Coordinates of a band, and bands: a pair at the limit is in no common band
#: with probability (1 - 0.8 ** 6) ** 48, less than one in two million.
BAND_ROWS = 6
BANDS = 48
BINS = BAND_ROWS * BANDS
#: Bands whose neighbours are confirmed first; below ``BANDS`` those of all bands
#: follow, across what is connected by then.  That moves fewer texts and takes one
#: more round of components.
FIRST_BANDS = BANDS
#: Members of a bucket that one task compares with each other, and their shingles.
BLOCK_ROWS = 2048
BLOCK_SHINGLES = 1 << 22
#: Cells of the counts that bound an overlap.
CELLS = 128
#: Shingles that are sketched together.
PART_SHINGLES = 1 << 17
#: Rows of numbers in a batch.
NUMBER_ROWS = 10_000

_MIX = np.uint64(0x9E3779B97F4A7C15)
_MIX2 = np.uint64(0xBF58476D1CE4E5B9)
_MIX3 = np.uint64(0x94D049BB133111EB)
_VALUE_BITS = np.uint64(44)
_VALUE = np.uint64((1 << 44) - 1)
_EMPTY = np.uint64((1 << 64) - 1)
_MOST = np.iinfo(np.uint16).max


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _MIX2
    x = (x ^ (x >> np.uint64(27))) * _MIX3
    return x ^ (x >> np.uint64(31))


def _seed(turn: int) -> np.uint64:
    return np.uint64((turn + 1) * int(_MIX) & ((1 << 64) - 1))


def _signed(values: np.ndarray) -> np.ndarray:
    return values.astype(np.uint64).view(np.int64)


def shingle_set(text: bytes | None, size: int = SHINGLE) -> np.ndarray:
    """Distinct hashes of the word shingles, ascending; fewer words are one shingle, no words none."""
    words = (text or b"").lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(w) for w in words), np.uint64, len(words))
    size = min(size, len(words))
    n = len(words) - size + 1
    out = np.full(n, size, np.uint64)
    for k in range(size):
        out = _mixed((out ^ hashes[k : n + k]) * _MIX)
    return np.unique(out)


def sketches(sets: list[np.ndarray], bins: int = BINS) -> np.ndarray:
    """The sketch of each set, a row each; rows of empty sets stay empty."""
    sizes = np.array([len(s) for s in sets], np.int64)
    out = np.full((len(sets), bins), _EMPTY, np.uint64)
    flat = out.reshape(-1)
    items = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
    owner = np.repeat(np.arange(len(sets)), sizes)
    for turn in range(2 * bins):
        if not len(items):
            break
        hashed = _mixed(items + _seed(turn))
        value = (np.uint64(turn) << _VALUE_BITS) | (hashed & _VALUE)
        if turn < bins:
            # The high bits choose the bin.
            place = (((hashed >> _VALUE_BITS) * np.uint64(bins)) >> np.uint64(20)).astype(np.int64)
        else:
            place = turn - bins
        np.minimum.at(flat, owner * bins + place, value)
        open_sets = (out == _EMPTY).any(axis=1)
        left = open_sets[owner]
        items, owner = items[left], owner[left]
    return out


def _parts(sets: list[np.ndarray]) -> Iterator[list[np.ndarray]]:
    """Runs of sets of few shingles in all, so that very long texts do not meet in one sketch."""
    start = held = 0
    for end, s in enumerate(sets):
        if end > start and held + len(s) > PART_SHINGLES:
            yield sets[start:end]
            start, held = end, 0
        held += len(s)
    if start < len(sets):
        yield sets[start:]


def band_keys(sketch: np.ndarray, rows: int = BAND_ROWS) -> np.ndarray:
    """A hash for each band of each sketch; different bands have different hashes."""
    bands = sketch.shape[1] // rows
    parts = sketch.reshape(len(sketch), bands, rows)
    out = np.broadcast_to(np.arange(1, bands + 1, dtype=np.uint64) * _MIX, parts.shape[:2]).copy()
    for k in range(rows):
        out = _mixed((out ^ parts[:, :, k]) * _MIX)
    return out


_LONGS = pa.list_(pa.int64())
#: A member of a block of a bucket.
_MEMBER = ["bucket", "block", "n", "key", "root", "own", "blocks"]


def _profile_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sets = [shingle_set(t) for t in column_values(batch, "text")]
        sketch = np.concatenate([sketches(part) for part in _parts(sets)] or [np.zeros((0, BINS), np.uint64)])
        keys = [xxhash.xxh3_128_intdigest(s.tobytes()) for s in sets]
        half = 1 << 63
        bands = _signed(band_keys(sketch))
        new = {
            "h1": pa.array([(k >> 64) - half for k in keys], pa.int64()),
            "h2": pa.array([(k & (2 * half - 1)) - half for k in keys], pa.int64()),
            "n": pa.array([len(s) for s in sets], pa.int64()),
            "bands": pa.array([b if len(s) else [] for b, s in zip(bands, sets, strict=True)], _LONGS),
        }
        yield with_columns(batch, ["doc_id", "t1", "t2"], new)


def _numbers(batches: Iterator[pa.RecordBatch], group: int) -> Iterator[tuple[list[np.ndarray], bool]]:
    """Columns of sorted batches, cut so that equal values of the first ``group``
    columns stay together; with each, whether it is the last."""
    kept: list[np.ndarray] | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
        if kept is not None:
            columns = [np.concatenate(x) for x in zip(kept, columns, strict=True)]
        same = np.ones(len(columns[0]), bool)
        for c in columns[:group]:
            same &= c == c[-1]
        cut = int(np.flatnonzero(~same).max(initial=-1)) + 1
        if cut:
            yield [c[:cut] for c in columns], False
        kept = [c[cut:] for c in columns]
    if kept is not None:
        yield kept, True


def _met_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of buckets with more than one member; what touches a task's ends stays, as it may go on in another.

    Rows pass one batch late, never a whole bucket at a time.
    """
    last: pa.RecordBatch | None = None
    before = None
    for batch in batches:
        if not batch.num_rows:
            continue
        if last is not None:
            yield _met(last, before, batch.column(0)[0].as_py())
            before = last.column(0)[-1].as_py()
        last = batch
    if last is not None:
        yield _met(last, before, None)


def _met(batch: pa.RecordBatch, before: int | None, after: int | None) -> pa.RecordBatch:
    bucket = batch.column(0).to_numpy(zero_copy_only=False)
    same = bucket[1:] == bucket[:-1]
    first = True if before is None else before == bucket[0]
    final = True if after is None else after == bucket[-1]
    return batch.filter(pa.array(np.concatenate(([first], same)) | np.concatenate((same, [final]))))


def _pair_batch(left: list[np.ndarray], right: list[np.ndarray]) -> pa.RecordBatch:
    a, b = np.concatenate(left), np.concatenate(right)
    both = np.unique(np.stack([np.minimum(a, b), np.maximum(a, b)]), axis=1)
    return pa.RecordBatch.from_arrays([pa.array(both[0]), pa.array(both[1])], names=["a", "b"])


def _neighbour_batches(percent: int):
    """Pairs of rows that follow each other in a bucket, of two components and of sizes that allow the similarity."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last: list[np.ndarray] | None = None
        for batch in batches:
            if not batch.num_rows:
                continue
            columns = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
            if last is not None:
                columns = [np.concatenate(x) for x in zip(last, columns, strict=True)]
            last = [c[-1:] for c in columns]
            bucket, n, key, root = columns
            near = (bucket[1:] == bucket[:-1]) & (root[1:] != root[:-1]) & (100 * n[:-1] >= percent * n[1:])
            yield _pair_batch([key[:-1][near]], [key[1:][near]])

    return run


def cells(shingles: np.ndarray) -> bytes:
    """How many shingles are in each cell of the hash range, two bytes each, the largest standing for more."""
    at = (shingles >> np.uint64(64 - CELLS.bit_length() + 1)).astype(np.int64)
    return np.minimum(np.bincount(at, minlength=CELLS), _MOST).astype("<u2").tobytes()


def may_be_similar(n: int, counts: np.ndarray, others: np.ndarray, other_counts: np.ndarray, percent: int) -> np.ndarray:
    """Which of the other sets can have that similarity with this one; never false for one that has."""
    most = np.minimum(other_counts, counts).sum(axis=1, dtype=np.int64)
    most = np.where((counts == _MOST).any(), n, most)
    return 100 * most >= percent * (n + others - most)


def _cell_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        counts = [cells(shingle_set(t)) for t in column_values(batch, "text")]
        yield with_columns(batch, ["key"], {"cells": pa.array(counts, pa.binary())})


def _near_pairs(columns: list[np.ndarray], percent: int) -> Iterator[tuple[int, int, int, np.ndarray]]:
    """Block by block, where it starts and ends, and for each row the earlier rows of
    other components that share no earlier bucket with it and are within the bound."""
    bucket, block, n, _, root, own, blocks, raw, bands = columns[:9]
    counts = np.frombuffer(b"".join(raw), "<u2").reshape(-1, CELLS)
    keys = np.stack(bands)
    new = np.flatnonzero((bucket[1:] != bucket[:-1]) | (block[1:] != block[:-1])) + 1
    for start, end in zip([0, *new], [*new, len(bucket)], strict=True):
        low, high = divmod(int(block[start]), int(blocks[start]))
        for a in range(start + 1, end):
            # Sizes ascend: smaller sets than this are too small.
            first = start + int(np.searchsorted(n[start:a], -(-percent * n[a] // 100)))
            other = high if own[a] == low else low
            near = first + np.flatnonzero((root[first:a] != root[a]) & (own[first:a] == other))
            if len(near):
                near = near[keys[a][(keys[near] == keys[a]).argmax(axis=1)] == bucket[a]]
            if len(near):
                near = near[may_be_similar(int(n[a]), counts[a], n[near], counts[near], percent)]
            if len(near):
                yield start, end, a, near


def _live_batches(percent: int):
    """The members of a block that have a pair to confirm, each once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for columns, _ in _numbers(batches, 2):
            live = np.zeros(len(columns[0]), bool)
            for _, _, a, near in _near_pairs(columns, percent):
                live[a] = live[near] = True
            yield pa.RecordBatch.from_arrays([pa.array(c[live]) for c in columns[: len(_MEMBER)]], names=_MEMBER)

    return run


def _join_batches(percent: int):
    """Links that join the components of a block, one less than these at most, confirmed on the whole sets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for columns, _ in _numbers(batches, 2):
            key, root, text = columns[3], columns[4], columns[9]
            links: list[tuple[int, int]] = []
            here, sets, joined = -1, [], {}

            def top(node: int, joined=joined) -> int:
                while node in joined:
                    node = joined[node]
                return node

            for start, end, a, near in _near_pairs(columns, percent):
                if start != here:
                    here, sets = start, [shingle_set(t) for t in text[start:end]]
                    joined.clear()
                for b in near:
                    one, two = top(int(root[a])), top(int(root[b]))
                    if one != two and similar(sets[b - start], sets[a - start], percent):
                        joined[max(one, two)] = min(one, two)
                        links.append((int(key[a]), int(key[b])))
            pairs = np.array(links, np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays([pa.array(pairs.min(axis=1)), pa.array(pairs.max(axis=1))], names=["a", "b"])

    return run


def similar(a: np.ndarray, b: np.ndarray, percent: int = SIMILAR_PERCENT) -> bool:
    """Whether two ascending sets have that Jaccard similarity."""
    if not len(a) or not len(b):
        return False
    at = np.minimum(np.searchsorted(b, a), len(b) - 1)
    common = int((b[at] == a).sum())
    return 100 * common >= percent * (len(a) + len(b) - common)


def _verify_batches(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, last_set = None, np.zeros(0, np.uint64)
        for batch in batches:
            good = []
            for b, left, right in zip(*(column_values(batch, c) for c in ("b", "left", "right")), strict=True):
                if b != last:  # rows of one b follow each other
                    last, last_set = b, shingle_set(right)
                good.append(similar(shingle_set(left), last_set, percent))
            kept = batch.filter(pa.array(good, pa.bool_()))
            yield kept.select(["a", "b"])

    return run


def _once_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows with one key that follow each other the first."""
    last = None
    for batch in batches:
        if batch.num_rows:
            key = batch.column(0).to_numpy(zero_copy_only=False)
            new = np.concatenate(([last is None or key[0] != last], key[1:] != key[:-1]))
            last = key[-1]
            yield batch.filter(pa.array(new))


def _sorted_by(rows: DataFrame, *names: str) -> DataFrame:
    """Ranges of the sort order: a bucket of any size is spread over as many tasks as it needs."""
    rows.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(NUMBER_ROWS))
    return rows.repartitionByRange(*names).sortWithinPartitions(*names)


class _Verification:
    """Candidate sets with their texts, and the pairs that have been looked at."""

    def __init__(self, texts: DataFrame, percent: int):
        self.texts, self.percent = texts, percent
        self.tried: DataFrame | None = None
        self.links: DataFrame | None = None

    def confirm(self, pairs: DataFrame) -> None:
        """Adds the links among the pairs that no earlier call has looked at."""
        pairs = pairs.distinct()
        if self.tried is not None:
            pairs = pairs.join(self.tried, ["a", "b"], "left_anti")
        pairs = stored(pairs, "pairs")
        small_batches(pairs.sparkSession)
        left = self.texts.select(F.col("key").alias("a"), F.col("text").alias("left"))
        right = self.texts.select(F.col("key").alias("b"), F.col("text").alias("right"))
        met = pairs.join(left, "a").join(right, "b").select("a", "b", "left", "right")
        self.tried = pairs if self.tried is None else self.tried.union(pairs)
        self.add(stored(met.mapInArrow(_verify_batches(self.percent), "a long, b long"), "links"))

    def add(self, links: DataFrame) -> None:
        """Adds links that have been confirmed."""
        self.links = links if self.links is None else self.links.union(links)

    def rooted(self, rows: DataFrame) -> DataFrame:
        """The rows with the component their key lies in by now."""
        roots = connected_components(self.links).withColumnRenamed("node", "key")
        return rows.join(roots, "key", "left").withColumn("root", F.coalesce("root", "key"))


def _across(rooted: DataFrame, sets: DataFrame, texts: DataFrame, percent: int, block_rows: int) -> DataFrame:
    """Links that join what is similar in a bucket and lies in different components, ``a, b``."""
    spark = rooted.sparkSession
    mixed = rooted.groupBy("bucket").agg(
        F.count(F.lit(1)).alias("members"), F.sum("n").alias("shingles"),
        F.min("root").alias("least"), F.max("root").alias("most"),
    ).filter("least < most")
    open_rows = stored(rooted.join(mixed.select("bucket", "members", "shingles"), "bucket"), "open")
    small_batches(spark)
    wanted = texts.join(open_rows.select("key").distinct(), "key", "left_semi").select("key", "text")
    counts = wanted.mapInArrow(_cell_batches, "key long, cells binary")
    signs = stored(counts.join(sets.select("key", "bands"), "key"), "cells")
    # A bucket above the block size is a group for every pair of its blocks.
    blocks = F.ceil(F.greatest(F.col("members") / block_rows, F.col("shingles") / BLOCK_SHINGLES)).cast("long")
    own = F.pmod(F.xxhash64("key"), F.col("blocks")).alias("own")
    spread = open_rows.withColumn("blocks", blocks).select("*", own).withColumn(
        "other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))
    )
    block: Column = F.least("own", "other") * F.col("blocks") + F.greatest("own", "other")

    def together(members: DataFrame, *more: str) -> DataFrame:
        grouped = members.select(*_MEMBER, "cells", "bands", *more)
        return grouped.repartition("bucket", "block").sortWithinPartitions("bucket", "block", "n", "key")

    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(NUMBER_ROWS))
    member = ", ".join(f"{name} long" for name in _MEMBER)
    live = together(spread.withColumn("block", block).join(signs, "key")).mapInArrow(_live_batches(percent), member)
    live = stored(live, "live")
    small_batches(spark)
    whole = together(live.join(signs, "key").join(texts.select("key", "text"), "key"), "text")
    return stored(whole.mapInArrow(_join_batches(percent), "a long, b long"), "links")


def near_duplicates(
    documents: DataFrame,
    percent: int = SIMILAR_PERCENT,
    first_bands: int = FIRST_BANDS,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """``doc_id, n_shingles, component_id`` for every row.

    ``component_id`` is the smallest doc_id reachable over links of that Jaccard
    similarity of the sets of four-word shingles, itself included.  Null and
    empty texts, and texts of white space, have an empty set and are linked with
    nothing.  A null doc_id takes part in links but is never a component's id; a
    component of null ids only has a null id.  Repeated rows each get their row.
    An empty table gives an empty one.  Other columns play no part.
    """
    spark = documents.sparkSession
    small_batches(spark)
    text = F.col("text").cast("string")
    rows = documents.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.xxhash64(text).alias("t1"),
        F.xxhash64(F.lit(1), text).alias("t2"),
        utf8("text").alias("text"),
    )
    profiles = stored(
        rows.mapInArrow(
            _profile_batches, "doc_id long, t1 long, t2 long, h1 long, h2 long, n long, bands array<long>"
        ),
        "sketches",
    )
    # Equal sets are one set, named by one of its rows.
    grouped = profiles.filter("n > 0").groupBy("h1", "h2", "n").agg(
        F.min("doc_id").alias("least"), F.min(F.struct("doc_id", "t1", "t2")).alias("named"), F.first("bands").alias("bands")
    )
    sets = stored(grouped.withColumn("key", F.monotonically_increasing_id()), "sets")

    banded = sets.select(F.posexplode("bands").alias("band", "bucket"), "n", "key").select("bucket", "n", "key", "band")
    met = _sorted_by(banded, "bucket", "n", "key").mapInArrow(
        _met_batches, "bucket long, n long, key long, band int"
    )
    buckets = stored(met, "buckets")

    small_batches(spark)
    named = sets.select("key", "named.*").join(buckets.select("key").distinct(), "key", "left_semi")
    same = [rows[c].eqNullSafe(named[c]) for c in ("doc_id", "t1", "t2")]
    # The join sorts by what names a row, so a row that repeats any number of times leaves a task once.
    once = rows.join(named, same).select("key", "text").mapInArrow(_once_batches, "key long, text binary")
    texts = stored(once, "texts")

    found = _Verification(texts, percent)
    plain = buckets.withColumn("root", F.col("key"))
    for bands in sorted({min(first_bands, BANDS), BANDS}):
        chosen = found.rooted(buckets) if found.links is not None else plain.filter(F.col("band") < bands)
        ordered = _sorted_by(chosen.select("bucket", "n", "key", "root"), "bucket", "n", "key")
        found.confirm(ordered.mapInArrow(_neighbour_batches(percent), "a long, b long"))
    rooted = stored(found.rooted(buckets).select("bucket", "n", "key", "root"), "rooted")
    found.add(_across(rooted, sets, texts, percent, block_rows))

    ids = found.rooted(sets.select("h1", "h2", "n", "key", "least"))
    least = ids.groupBy("root").agg(F.min("least").alias("component_id"))
    known = stored(ids.join(least, "root").select("h1", "h2", "n", "component_id"), "components")
    linked = profiles.join(known, ["h1", "h2", "n"], "left")
    component = F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    return linked.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"))

