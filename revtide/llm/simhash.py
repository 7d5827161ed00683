"""Near copies by 64-bit fingerprints that differ in few bits.

Candidate search follows the generalised pigeonhole principle.  The bits are
dealt into partitions, correlated ones together.  If the thresholds ``t_i`` of
the partitions sum to ``radius - partitions + 1``, two fingerprints within
``radius`` agree to within ``t_i`` bits in at least one partition, so only
those need a look; a threshold of -1 passes a partition over.  Every
fingerprint gets its own thresholds: dynamic programming over the partitions
picks the ones with the least estimated work, counted from the histograms of
the partitions' values.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revtide.llm.common import column_values, quoted, small_batches, stored, utf8, with_columns
from revtide.llm.components import connected_components

BITS = 64
SHINGLE = 3
RADIUS = 3
#: Histograms cover so many bits of a partition's value, whatever its width.
HISTOGRAM_BITS = 16
#: Work of one more row in the shuffle, in comparisons of two fingerprints.
PROBE_COST = 64.0
#: Members of a bucket, about, that one task compares with each other.
BLOCK_ROWS = 1 << 15
#: Buckets up to this size are compared by shifting, larger ones by a forest.
SHORT_RUN = 32

_BYTE_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(np.int64)


def fingerprint(text: bytes | None) -> int:
    """SimHash of the word shingles; 0 without words."""
    words = (text or b"").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    if len(words) < SHINGLE:
        spans = iter([(0, len(joined))])
    else:
        spans = zip(starts[: 1 - SHINGLE].tolist(), ends[SHINGLE - 1 :].tolist(), strict=True)
    digest = xxhash.xxh64_intdigest
    counts, total = np.zeros(BITS, np.int64), 0
    while block := list(itertools.islice(spans, 1 << 16)):
        hashes = np.array([digest(joined[a:b], 42) for a, b in block], dtype=np.uint64)
        by_byte = hashes.astype("<u8").view(np.uint8).reshape(-1, 8)
        for k in range(8):
            counts[8 * k : 8 * k + 8] += np.bincount(by_byte[:, k], minlength=256) @ _BYTE_BITS
        total += len(block)
    ones = np.flatnonzero(2 * counts > total)
    return sum(1 << int(bit) for bit in ones)


def _signed(values: np.ndarray) -> np.ndarray:
    return values.astype(np.uint64).view(np.int64)


def _fingerprint_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        values = np.array([fingerprint(t) for t in column_values(batch, "text")], dtype=np.uint64)
        yield with_columns(batch, ["doc_id", "text_hash"], {"fp": pa.array(_signed(values))})


def fingerprints(documents: DataFrame) -> DataFrame:
    """``doc_id, text_hash, fp`` for every row; fp is the fingerprint as a signed long."""
    small_batches(documents.sparkSession)
    rows = documents.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.xxhash64(F.col("text").cast("string")).alias("text_hash"),
        utf8("text").alias("text"),
    )
    return rows.mapInArrow(_fingerprint_batches, "doc_id long, text_hash long, fp long")


# Dealing the bits

def _together(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How often each pair of bits is set together, a row per pair."""
    total = np.zeros((BITS, BITS))
    for batch in batches:
        values = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
        bits = np.unpackbits(values.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        bits = bits.astype(np.float32)
        total += bits.T @ bits
    i, j = np.triu_indices(BITS)
    yield pa.RecordBatch.from_arrays(
        [pa.array(i), pa.array(j), pa.array(total[i, j].astype(np.int64))], names=["i", "j", "n"]
    )


def bit_correlations(distinct: DataFrame) -> tuple[np.ndarray, int]:
    """Absolute correlations of the 64 bits over all fingerprints, and their number."""
    sums = distinct.select("fp").mapInArrow(_together, "i long, j long, n long").groupBy("i", "j").agg(F.sum("n").alias("n"))
    rows = distinct.count()
    both = np.zeros((BITS, BITS))
    for i, j, n in sums.collect():  # 2,080 rows at any size
        both[i, j] = both[j, i] = n
    if not rows:
        return np.zeros((BITS, BITS)), 0
    p = np.diag(both) / rows
    spread = np.sqrt(np.maximum(p * (1 - p), 1e-12))
    return np.abs((both / rows - np.outer(p, p)) / np.outer(spread, spread)), rows


def partition_count(rows: int, radius: int = RADIUS) -> int:
    """Fewer and wider partitions for more fingerprints: least estimated work per row."""
    def work(m: int) -> float:
        width, spare = BITS // m, radius - m + 1
        share, extra = divmod(max(spare, 0), m)
        masks = [sum(_choose(width, k) for k in range(share + (i < extra) + 1)) for i in range(m)]
        return PROBE_COST * (sum(masks) + m) + rows * sum(masks) / 2.0**width

    return min(range(2, radius + 2), key=work)


def _choose(n: int, k: int) -> int:
    out = 1
    for i in range(k):
        out = out * (n - i) // (i + 1)
    return out


def deal_bits(correlation: np.ndarray, partitions: int) -> list[list[int]]:
    """Groups of bits of near-equal size; each takes the bits closest to those it has."""
    free, groups = list(range(BITS)), []
    for k in range(partitions):
        size = len(free) // (partitions - k)
        group = [min(free, key=lambda b: (-correlation[b, free].sum(), b))]
        free.remove(group[0])
        while len(group) < size:
            best = min(free, key=lambda b: (-correlation[b, group].sum(), b))
            group.append(best)
            free.remove(best)
        groups.append(sorted(group))
    return groups


# Thresholds

@dataclass(frozen=True)
class Plan:
    """How candidates are searched; its size does not depend on the data."""

    groups: list[list[int]]
    #: By partition and threshold from 0: candidates expected for each value's histogram bits.
    expected: list[list[np.ndarray]]
    #: By partition: members of the bucket of each value's histogram bits.
    sizes: list[np.ndarray]
    radius: int
    block_rows: int


def projected(values: np.ndarray, group: list[int]) -> np.ndarray:
    out = np.zeros(len(values), np.int64)
    for place, bit in enumerate(group):
        out |= ((values >> np.uint64(bit)) & np.uint64(1)).astype(np.int64) << place
    return out


def _histogram_key(value: np.ndarray) -> np.ndarray:
    return value & ((1 << HISTOGRAM_BITS) - 1)


def _histogram_batches(groups: list[list[int]]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            for k, group in enumerate(groups):
                key, n = np.unique(_histogram_key(projected(values, group)), return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(key), k)), pa.array(key), pa.array(n)], names=["part", "key", "n"]
                )

    return run


def search_plan(distinct: DataFrame, radius: int = RADIUS, block_rows: int = BLOCK_ROWS) -> Plan:
    correlation, rows = bit_correlations(distinct)
    groups = deal_bits(correlation, partition_count(rows, radius))
    counted = distinct.select("fp").mapInArrow(_histogram_batches(groups), "part long, key long, n long")
    table = counted.groupBy("part", "key").agg(F.sum("n").alias("n")).toPandas()  # 2^16 keys a partition at most
    sizes, expected = [], []
    for k, group in enumerate(groups):
        bits = min(len(group), HISTOGRAM_BITS)
        own = table[table.part == k]
        counts = np.zeros(1 << bits)
        counts[own.key.to_numpy()] = own.n.to_numpy()
        counts /= 2.0 ** (len(group) - bits)  # the bits beyond the histogram taken as even
        sizes.append(counts)
        expected.append(_within(counts, bits, radius))
    return Plan(groups, expected, sizes, radius, block_rows)


def _within(counts: np.ndarray, bits: int, radius: int) -> list[np.ndarray]:
    """For each value, how many counted values lie within 0, 1, ... ``radius`` bits."""
    shells, every = [counts], np.arange(len(counts))

    def next_to(shell: np.ndarray) -> np.ndarray:
        return sum(shell[every ^ (1 << b)] for b in range(bits))

    for k in range(radius):
        before = (bits - k + 1) * shells[k - 1] if k else 0.0
        shells.append((next_to(shells[k]) - before) / (k + 1))
    return list(np.cumsum(np.maximum(shells, 0), axis=0))


def thresholds(values: np.ndarray, plan: Plan) -> np.ndarray:
    """For each fingerprint and partition the threshold, -1 to pass it over."""
    parts, n = len(plan.groups), len(values)
    goal = plan.radius - parts + 1
    choices = range(-1, plan.radius + 1)
    least = {0: np.zeros(n)}
    picks: list[dict[int, np.ndarray]] = []
    for k, group in enumerate(plan.groups):
        key = _histogram_key(projected(values, group))
        cost = {-1: np.zeros(n)}
        for t in choices[1:]:
            probes = sum(_choose(len(group), j) for j in range(t + 1))
            cost[t] = plan.expected[k][t][key] + PROBE_COST * probes
        best: dict[int, np.ndarray] = {}
        pick: dict[int, np.ndarray] = {}
        for total, so_far in least.items():
            for t in choices:
                s, work = total + t, so_far + cost[t]
                if s - (parts - 1 - k) > goal:  # the rest lowers the sum by one each at most
                    continue
                if s not in best:
                    best[s], pick[s] = work.copy(), np.full(n, t, np.int8)
                else:
                    better = work < best[s]
                    best[s] = np.where(better, work, best[s])
                    pick[s] = np.where(better, np.int8(t), pick[s])
        least = best
        picks.append(pick)
    out, total = np.zeros((n, parts), np.int8), np.full(n, goal)
    for k in reversed(range(parts)):
        for s, pick in picks[k].items():
            at = total == s
            out[at, k] = pick[at]
        total = total - out[:, k]
    return out


# Candidates

def _masks(width: int, threshold: int) -> np.ndarray:
    return np.array(
        [sum(1 << b for b in bits) for k in range(1, threshold + 1) for bits in itertools.combinations(range(width), k)],
        dtype=np.int64,
    )


def _bucket_batches(shared):
    """Rows ``bucket, block, fp, active``: each fingerprint under its own values and under those it probes."""

    def rows(part: int, value: np.ndarray, fp: np.ndarray, active: np.ndarray, plan: Plan):
        bucket = (np.int64(part) << np.int64(58)) | value
        blocks = np.ceil(plan.sizes[part][_histogram_key(value)] / plan.block_rows).astype(np.int64).clip(1)
        own = ((fp * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(33)).astype(np.int64) % blocks
        for other in range(int(blocks.max(initial=1))):
            at = other < blocks
            low, high = np.minimum(own[at], other), np.maximum(own[at], other)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(bucket[at]),
                    pa.array(low * blocks[at] + high),
                    pa.array(_signed(fp[at])),
                    pa.array(active[at]),
                ],
                names=["bucket", "block", "fp", "active"],
            )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        plan = shared.value
        for batch in batches:
            fp = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            chosen = thresholds(fp, plan)
            for part, group in enumerate(plan.groups):
                value = projected(fp, group)
                yield from rows(part, value, fp, chosen[:, part] >= 0, plan)
                for t in range(1, plan.radius + 1):
                    at = chosen[:, part] == t
                    if at.any():
                        for mask in _masks(len(group), t):
                            yield from rows(part, value[at] ^ mask, fp[at], np.ones(at.sum(), bool), plan)

    return run


def _forest(fp: np.ndarray, active: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links that connect the same members as all links of active members do."""
    label = np.arange(len(fp))
    left, right = [], []
    for a in np.flatnonzero(active):
        apart = label != label[a]
        if not apart.any():
            break
        near = np.flatnonzero(apart)
        near = near[np.bitwise_count(fp[near] ^ fp[a]) <= radius]
        if len(near):
            groups, first = np.unique(label[near], return_index=True)
            left.append(np.full(len(first), fp[a]))
            right.append(fp[near[first]])
            label[np.isin(label, groups)] = label[a]
    empty = np.zeros(0, np.uint64)
    return (np.concatenate(left), np.concatenate(right)) if left else (empty, empty)


def links_in_runs(bucket, block, fp, active, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Verified links among rows sorted by bucket and block; connects what all links connect."""
    new = np.flatnonzero(np.concatenate(([True], (bucket[1:] != bucket[:-1]) | (block[1:] != block[:-1]))))
    length = np.diff(np.append(new, len(bucket)))
    run, size = np.repeat(np.arange(len(new)), length), np.repeat(length, length)
    left, right = [], []
    short = np.flatnonzero(size <= SHORT_RUN)
    for shift in range(1, int(size[short].max(initial=1))):
        a, b = short[:-shift], short[shift:]
        near = (run[a] == run[b]) & (active[a] | active[b])
        a, b = a[near], b[near]
        near = np.bitwise_count(fp[a] ^ fp[b]) <= radius
        left.append(fp[a[near]])
        right.append(fp[b[near]])
    for k in np.flatnonzero(length > SHORT_RUN):
        at = slice(new[k], new[k] + length[k])
        a, b = _forest(fp[at], active[at], radius)
        left.append(a)
        right.append(b)
    empty = np.zeros(0, np.uint64)
    return (np.concatenate(left), np.concatenate(right)) if left else (empty, empty)


def _link_batches(radius: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: list[np.ndarray] | None = None

        def linked(columns: list[np.ndarray]) -> pa.RecordBatch:
            a, b = links_in_runs(*columns, radius)
            a, b = a[a != b], b[a != b]
            return pa.RecordBatch.from_arrays([pa.array(_signed(a)), pa.array(_signed(b))], names=["a", "b"])

        for batch in batches:
            if not batch.num_rows:
                continue
            columns = [batch.column(k).to_numpy(zero_copy_only=False) for k in range(4)]
            columns[2] = columns[2].view(np.uint64)
            if kept is not None:
                columns = [np.concatenate(x) for x in zip(kept, columns, strict=True)]
            bucket, block = columns[:2]
            # The last run may go on in the next batch.
            cut = int(np.flatnonzero((bucket != bucket[-1]) | (block != block[-1])).max(initial=-1)) + 1
            if cut:
                yield linked([c[:cut] for c in columns])
            kept = [c[cut:] for c in columns]
        if kept is not None:
            yield linked(kept)

    return run


def near_links(distinct: DataFrame, radius: int = RADIUS, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Pairs ``a, b`` of distinct fingerprints within ``radius`` bits, enough to
    connect whatever all such pairs connect.

    Buckets above ``block_rows`` are split, and every pair of blocks is a group
    of its own, so that no task holds more than two blocks.
    """
    spark = distinct.sparkSession
    plan = spark.sparkContext.broadcast(search_plan(distinct, radius, block_rows))
    buckets = distinct.select("fp").mapInArrow(
        _bucket_batches(plan), "bucket long, block long, fp long, active boolean"
    )
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "10000")
    together = buckets.repartition("bucket", "block").sortWithinPartitions("bucket", "block")
    return together.mapInArrow(_link_batches(radius), "a long, b long")


def near_duplicates(documents: DataFrame, radius: int = RADIUS) -> DataFrame:
    """``doc_id, text_hash, fp, component_id`` for every row.

    ``component_id`` is the smallest doc_id reachable over links of ``radius``
    bits or fewer.  Null and empty texts, and texts of white space, have
    fingerprint 0 and link like any other.  A null doc_id takes part in links
    but is never a component's id; a component of null ids only has a null id.
    Repeated rows each get their row.  An empty table gives an empty one.
    """
    rows = stored(fingerprints(documents), "fingerprints")
    distinct = stored(rows.groupBy("fp").agg(F.min("doc_id").alias("least")), "distinct")
    stars = connected_components(near_links(distinct, radius)).withColumnRenamed("node", "fp")
    rooted = distinct.join(stars, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    ids = rooted.join(least, "root").select("fp", "component_id")
    return rows.join(ids, "fp").select("doc_id", "text_hash", "fp", "component_id")


def one_of_each(documents: DataFrame, radius: int = RADIUS) -> DataFrame:
    """The documents without near copies: of each component the row with its id.

    Near copies are what ``near_duplicates`` links.  Columns are kept as they
    are.  Of rows that repeat doc_id and text one stays; rows without a doc_id
    stay, as nothing names them.
    """
    names = quoted(documents.columns)
    kept = near_duplicates(documents, radius).filter("doc_id = component_id").select(
        F.col("doc_id").alias("_kept_id"), F.col("text_hash").alias("_kept_text")
    ).distinct()
    marked = documents.withColumn("_kept_text", F.xxhash64(F.col("text").cast("string"))).withColumn(
        "_kept_id", F.col("doc_id").cast("long")
    )
    named = marked.filter("_kept_id IS NOT NULL").join(kept, ["_kept_id", "_kept_text"], "left_semi")
    named = named.dropDuplicates(["_kept_id", "_kept_text"])
    return named.select(*names).union(marked.filter("_kept_id IS NULL").select(*names))
