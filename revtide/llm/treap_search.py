"""Ranked search over K2-treaps of terms and documents.

Every task cuts its documents into shards and builds over each a grid of terms
(rows, frequent ones first) and documents (columns, by id).  The grid is a
quadtree in which a cell takes the largest impact of its points for itself and
hands the others down to its quadrants, so each point sits in exactly one cell
and the maxima fall along every path.  Cells of a level lie in one array in
Z-order; four bits a cell say which quadrants exist, and counting them finds a
child's place.

A query descends the row paths of all its terms jointly.  A state is a range of
documents with one cell a term.  Where a cell's own point lies in the term's row
its document is scored in full at once, so the sum of the weighted maxima bounds
the score of every other document of the range.  The ranges with the highest
bounds are split first, until no bound reaches the worst of the best documents.
A first short descent in all shards finds a score that the best documents of the
whole corpus reach; with it most ranges fall at the top of their shard.

Impacts leave the term's weight out, so that only the number and the mean length
of all documents must be known to build a shard; weights come in at query time.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from revtide.llm.common import column_values, small_batches, stored, utf8

TOP = 10
#: Share of a document's length in the saturation of its counts, in percent.
LENGTH_PERCENT = 90
#: Postings and documents of a shard; a document above that is a shard by itself.
SHARD_POINTS = 1 << 21
SHARD_DOCUMENTS = 1 << 14
#: Queries that are sent to the tasks together.
QUERY_BLOCK = 4096
#: Ranges of a query that are split in one step, in the first steps and at most.
FIRST_STEP = 4
STEP = 512
#: Steps of the first descent, enough to reach single columns.
SEED_STEPS = 24
#: Queries that descend side by side.
TOGETHER = 64

_SEPARATORS = bytes(b for b in range(128) if not chr(b).isalnum())
_TABLE = bytes.maketrans(_SEPARATORS, b" " * len(_SEPARATORS))


def terms(text: bytes | None) -> list[bytes]:
    """Maximal runs of letters, digits and characters beyond ASCII, A-Z in lower case."""
    return (text or b"").translate(_TABLE).lower().split()


def weight(documents: int, holding: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * holding + 1)))


def length_factor(n: int, documents: int, all_terms: int) -> int:
    return 100 - LENGTH_PERCENT + (LENGTH_PERCENT * n * documents) // all_terms


def impact(tf: int, m: int) -> int:
    return (1_000_000_000 * tf) // (1000 * tf + 8 * m)


# The treap

@dataclass
class Treap:
    """Levels from the root down; a cell's point is its row and column within the cell."""

    height: int
    #: By level: the impact of each cell's point, and the point's row and column.
    top: list[np.ndarray]
    row: list[np.ndarray]
    column: list[np.ndarray]
    #: By level: four bits a cell, and how many are set before each cell.
    children: list[np.ndarray]
    before: list[np.ndarray]


def build(row: np.ndarray, column: np.ndarray, value: np.ndarray, height: int) -> Treap:
    """The treap of points in a square of ``2 ** height``; no two points in one place."""
    code = _interleaved(row, column)
    order = np.argsort(code)
    code, value = code[order], value[order]
    treap = Treap(height, [], [], [], [], [])
    for level in range(height + 1):
        if not len(code):
            break
        shift = np.uint64(2 * (height - level))
        cell = code >> shift
        start = np.flatnonzero(np.concatenate(([True], cell[1:] != cell[:-1])))
        size = np.diff(np.append(start, len(cell)))
        most = np.maximum.reduceat(value, start)
        # The first point that has the maximum is the cell's own.
        at = np.flatnonzero(value == np.repeat(most, size))
        owner = np.searchsorted(start, at, side="right") - 1
        own = at[np.concatenate(([True], owner[1:] != owner[:-1]))]
        within = code[own] & ((np.uint64(1) << shift) - np.uint64(1))
        treap.top.append(most)
        treap.row.append(_gathered(within >> np.uint64(1)))
        treap.column.append(_gathered(within))
        left = np.ones(len(code), bool)
        left[own] = False
        index = np.repeat(np.arange(len(start)), size)[left]
        code, value = code[left], value[left]
        bits = np.zeros(len(start), np.uint8)
        if level < height:
            quadrant = ((code >> (shift - np.uint64(2))) & np.uint64(3)).astype(np.int64)
            np.bitwise_or.at(bits, index, (1 << quadrant).astype(np.uint8))
        treap.children.append(bits)
        treap.before.append(np.concatenate(([0], np.cumsum(np.bitwise_count(bits))[:-1])).astype(np.int64))
    return treap


_SPREAD = [
    (np.uint64(16), np.uint64(0x0000FFFF0000FFFF)), (np.uint64(8), np.uint64(0x00FF00FF00FF00FF)),
    (np.uint64(4), np.uint64(0x0F0F0F0F0F0F0F0F)), (np.uint64(2), np.uint64(0x3333333333333333)),
    (np.uint64(1), np.uint64(0x5555555555555555)),
]


def _interleaved(row: np.ndarray, column: np.ndarray) -> np.ndarray:
    """Bits of row and column in turn, those of the row higher."""
    out = []
    for x in (row, column):
        x = x.astype(np.uint64)
        for shift, mask in _SPREAD:
            x = (x | (x << shift)) & mask
        out.append(x)
    return (out[0] << np.uint64(1)) | out[1]


def _gathered(code: np.ndarray) -> np.ndarray:
    """Every second bit of the codes, from the lowest on."""
    x = code & _SPREAD[-1][1]
    for (shift, _), (_, mask) in zip(reversed(_SPREAD), [*reversed(_SPREAD[:-1]), (None, np.uint64(0xFFFFFFFF))], strict=True):
        x = (x | (x >> shift)) & mask
    return x.astype(np.int64)


def _child(treap: Treap, level: int, cells: np.ndarray, quadrant: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which cells have a child in a quadrant, and the children's numbers where they do."""
    bits = treap.children[level][cells]
    has = (bits >> quadrant) & 1 == 1
    below = (1 << quadrant[has]) - 1
    return has, treap.before[level][cells[has]] + np.bitwise_count(bits[has] & below)


@dataclass(frozen=True)
class Asked:
    """Some queries: rows and weights of their terms one query after the other."""

    first: np.ndarray
    rows: np.ndarray
    weights: np.ndarray

    @staticmethod
    def of(queries: list[tuple[np.ndarray, np.ndarray]]) -> Asked:
        sizes = [len(rows) for rows, _ in queries]
        none = [np.zeros(0, np.int64)]
        return Asked(
            np.concatenate(([0], np.cumsum(sizes))).astype(np.int64),
            np.concatenate([r for r, _ in queries] or none).astype(np.int64),
            np.concatenate([w for _, w in queries] or none).astype(np.int64),
        )


def _spans(first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The places of spans one after the other."""
    ends = np.cumsum(size)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(first - ends + size, size)


def scores(
    treap: Treap, level: int, least: np.ndarray, column: np.ndarray, pair, term, cell, asked: Asked
) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of a query and a column that reach the pair's least score, and their full scores.

    ``pair, term, cell`` have the terms' cells at ``level``, pair by pair; cells
    above hold no points of the pairs' columns in the terms' rows.  A pair goes
    as soon as what it has and what its cells allow stay below its least.
    """
    out = np.zeros(len(column), np.int64)
    for k in range(level, len(treap.top)):
        if not len(term):
            break
        shift = treap.height - k
        low = (1 << shift) - 1
        row, col = asked.rows[term], column[pair]
        own = (treap.row[k][cell] == row & low) & (treap.column[k][cell] == col & low)
        np.add.at(out, pair[own], treap.top[k][cell[own]] * asked.weights[term[own]])
        if k + 1 == len(treap.top):
            break
        left = np.flatnonzero(~own)
        quadrant = (row[left] >> (shift - 1) & 1) * 2 + (col[left] >> (shift - 1) & 1)
        has, cell = _child(treap, k, cell[left], quadrant)
        term, pair = term[left[has]], pair[left[has]]
        bound = out.copy()
        np.add.at(bound, pair, treap.top[k + 1][cell] * asked.weights[term])
        alive = (bound >= least)[pair]
        term, pair, cell = term[alive], pair[alive], cell[alive]
        out[bound < least] = 0
    good = np.flatnonzero((out >= least) & (out > 0))
    return good, out[good]


class _Ranges:
    """Ranges of columns still to be split: query, level, first column, bound, and the cells of the terms that have one."""

    def __init__(self):
        none = np.zeros(0, np.int64)
        self.states = [none] * 6  # query, level, prefix, bound, first, size
        self.cells = [none, none]  # term, cell

    def add(self, query, level, prefix, bound, size, term, cell) -> None:
        first = len(self.cells[0]) + np.cumsum(size) - size
        new = (query, np.full(len(query), level), prefix, bound, first, size)
        self.states = [np.concatenate(x) for x in zip(self.states, new, strict=True)]
        self.cells = [np.concatenate(x) for x in zip(self.cells, (term, cell), strict=True)]

    def take(self, most: int, least: np.ndarray) -> list[np.ndarray]:
        """Of each query the ranges with the highest bounds; those below its least go."""
        query, bound = self.states[0], self.states[3]
        at = np.flatnonzero(bound >= least[query])
        order = at[np.lexsort((-bound[at], query[at]))]
        new = np.flatnonzero(np.concatenate(([True], query[order][1:] != query[order][:-1]))) if len(order) else order
        rank = np.arange(len(order)) - np.repeat(new, np.diff(np.append(new, len(order))))
        taken = [*(x[order[rank < most]] for x in self.states)]
        cells = self.cells
        rest = order[rank >= most]
        # What is left moves together.
        keep = _spans(self.states[4][rest], self.states[5][rest])
        moved = [x[rest] for x in self.states]
        moved[4] = np.cumsum(moved[5]) - moved[5]
        self.states, self.cells = moved, [x[keep] for x in cells]
        place = _spans(taken[4], taken[5])
        return [*taken[:3], taken[5], cells[0][place], cells[1][place]]


def best(
    treap: Treap, columns: int, asked: Asked, top: int, least: np.ndarray, steps: int | None = None
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each query the best ``top`` columns as ``query, score, column``, scores of
    its ``least`` (1 at least) or more; of equal scores the first columns.

    The queries descend side by side.  With a number of ``steps`` the search may
    end early, with true scores of good columns.
    """
    queries = len(asked.first) - 1
    least = np.maximum(least, 1)
    none = np.zeros(0, np.int64)
    found = [none, none, none]
    sizes = np.diff(asked.first)
    some = np.flatnonzero(sizes)
    if not treap.top or not len(some):
        return tuple(found)
    done = np.zeros(queries * columns, bool)
    ranges = _Ranges()
    every = _spans(asked.first[some], sizes[some])
    bound = np.bincount(np.repeat(some, sizes[some]), asked.weights[every], queries)[some] * treap.top[0][0]
    ranges.add(some, 0, np.zeros(len(some), np.int64), bound.astype(np.int64), sizes[some], every, np.zeros(len(every), np.int64))
    turn = 0
    while steps is None or turn < steps:
        size = FIRST_STEP if turn < SEED_STEPS else min(FIRST_STEP << (turn - SEED_STEPS + 1), STEP)
        query, level, prefix, held, term, cell = ranges.take(size, least)
        if not len(query):
            break
        turn += 1
        first = np.cumsum(held) - held
        met = []
        for k in np.unique(level).tolist():
            here = np.flatnonzero(level == k)
            place = _spans(first[here], held[here])
            cells = np.repeat(np.arange(len(here)), held[here]), term[place], cell[place]
            met.append(_split(treap, k, query[here], prefix[here], held[here], *cells, asked, columns, done, least, ranges))
        both = [np.concatenate(x) for x in zip(found, *met, strict=True)]
        order = np.lexsort((both[2], -both[1], both[0]))
        first = np.searchsorted(both[0][order], np.arange(queries))
        rank = np.arange(len(order)) - first[both[0][order]]
        found = [x[order[rank < top]] for x in both]
        full = order[rank == top - 1]
        least[both[0][full]] = both[1][full]
    return tuple(found)


def _split(treap: Treap, level: int, query, prefix, held, state, term, cell, asked: Asked, columns, done, least, ranges):
    """Adds the halves of ranges of one level; returns ``query, score, column`` of
    documents that a cell's own point brings up, each once.

    The cells above have brought up the columns of all their points in the
    terms' rows, so for a new column the cells of its range say all.
    """
    shift = treap.height - level
    row = asked.rows[term]
    own = treap.row[level][cell] == row & ((1 << shift) - 1)
    column = (prefix[state[own]] << shift) | treap.column[level][cell[own]]
    key, at = np.unique(query[state[own]] * columns + column, return_index=True)
    new = ~done[key]
    done[key] = True
    column, home = column[at[new]], state[own][at[new]]
    place = _spans((np.cumsum(held) - held)[home], held[home])
    pair = np.repeat(np.arange(len(home)), held[home])
    good, sums = scores(treap, level, least[query[home]], column, pair, term[place], cell[place], asked)
    if level + 1 < len(treap.top):
        row_bit = (row >> (shift - 1) & 1) * 2
        for half in (0, 1):
            has, below = _child(treap, level, cell, row_bit + half)
            kept, lanes = state[has], term[has]
            if len(kept):
                start = np.concatenate(([0], np.flatnonzero(kept[1:] != kept[:-1]) + 1))
                bound = np.add.reduceat(treap.top[level + 1][below] * asked.weights[lanes], start)
                size = np.diff(np.append(start, len(kept)))
                ranges.add(query[kept[start]], level + 1, prefix[kept[start]] * 2 + half, bound, size, lanes, below)
    return query[home[good]], sums, column[good]


# Shards

INDEX = (
    "doc_ids array<long>, height int, words binary, hashes binary, hash_rows binary, holding binary, "
    "top array<binary>, `row` array<binary>, `column` array<binary>, children array<binary>"
)
_BINARIES = pa.list_(pa.binary())


def _shard(doc_ids: list, lengths: list[int], postings: list[tuple], words: list[bytes], documents: int, all_terms: int):
    """The index row of a shard."""
    order = sorted(range(len(doc_ids)), key=lambda d: (doc_ids[d] is None, doc_ids[d] or 0))
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    column = np.repeat(place, [len(p[0]) for p in postings])
    term = np.concatenate([p[0] for p in postings]).astype(np.int64)
    tf = np.concatenate([p[1] for p in postings]).astype(np.int64)
    m = np.array([length_factor(n, documents, all_terms) for n in lengths], np.int64)
    value = 1_000_000_000 * tf // (1000 * tf + 8 * np.repeat(m, [len(p[0]) for p in postings]))
    holding = np.bincount(term, minlength=len(words))
    by_frequency = np.argsort(-holding, kind="stable")
    row = np.empty(len(words), np.int64)
    row[by_frequency] = np.arange(len(words))
    height = max(len(words) - 1, len(doc_ids) - 1).bit_length()
    treap = build(row[term], column, value, height)
    ranked = [words[t] for t in by_frequency]
    hashes = np.fromiter((xxhash.xxh64_intdigest(w) for w in ranked), np.uint64, len(ranked))
    by_hash = np.argsort(hashes)

    def packed(levels: list[np.ndarray], kind: str | None = None) -> list[bytes]:
        # The coordinates of small cells need few bytes.
        return [x.astype(kind or np.min_scalar_type(int(x.max(initial=0))).newbyteorder("<")).tobytes() for x in levels]

    return {
        "doc_ids": [doc_ids[d] for d in order], "height": height, "words": b" ".join(ranked),
        "hashes": hashes[by_hash].astype("<u8").tobytes(), "hash_rows": by_hash.astype("<i4").tobytes(),
        "holding": holding[by_frequency].astype("<i4").tobytes(), "top": packed(treap.top, "<u4"),
        "row": packed(treap.row), "column": packed(treap.column), "children": packed(treap.children, "u1"),
    }


_SHARD = pa.schema(
    [
        ("doc_ids", pa.list_(pa.int64())), ("height", pa.int32()),
        *((name, pa.binary()) for name in ("words", "hashes", "hash_rows", "holding")),
        *((name, _BINARIES) for name in ("top", "row", "column", "children")),
    ]
)


def _build_batches(documents: int, all_terms: int, shard_points: int, shard_documents: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        doc_ids, lengths, postings, number, points = [], [], [], {}, 0

        def shard() -> pa.RecordBatch:
            row = _shard(doc_ids, lengths, postings, list(number), documents, all_terms)
            return pa.RecordBatch.from_pylist([row], _SHARD)

        for batch in batches:
            for doc_id, text in zip(column_values(batch, "doc_id"), column_values(batch, "text"), strict=True):
                counts = Counter(terms(text))
                if not counts:
                    continue
                doc_ids.append(doc_id)
                lengths.append(counts.total())
                ids = np.fromiter((number.setdefault(t, len(number)) for t in counts), np.int32, len(counts))
                postings.append((ids, np.fromiter(counts.values(), np.int32, len(counts))))
                points += len(counts)
                if points >= shard_points or len(doc_ids) >= shard_documents:
                    yield shard()
                    doc_ids, lengths, postings, number, points = [], [], [], {}, 0
        if doc_ids:
            yield shard()

    return run


class Shard:
    """A shard read back."""

    def __init__(self, row: dict):
        self.doc_ids = row["doc_ids"]
        self.words = row["words"].split(b" ")
        self.hashes = np.frombuffer(row["hashes"], "<u8")
        self.hash_rows = np.frombuffer(row["hash_rows"], "<i4")
        self.holding = np.frombuffer(row["holding"], "<i4")
        top = [np.frombuffer(x, "<u4").astype(np.int64) for x in row["top"]]

        def unpacked(name: str) -> list[np.ndarray]:
            return [np.frombuffer(x, f"<u{len(x) // len(t)}") for x, t in zip(row[name], top, strict=True)]

        children = unpacked("children")
        before = [np.concatenate(([0], np.cumsum(np.bitwise_count(c), dtype=np.int64)[:-1])) for c in children]
        self.treap = Treap(row["height"], top, unpacked("row"), unpacked("column"), children, before)

    def rows_of(self, wanted: list[bytes], hashes: np.ndarray) -> np.ndarray:
        """The rows of terms, -1 for those that no document here has."""
        out = np.full(len(wanted), -1, np.int64)
        at = np.searchsorted(self.hashes, hashes)
        near = np.flatnonzero((at < len(self.hashes)) & (self.hashes[np.minimum(at, len(self.hashes) - 1)] == hashes))
        for k in near.tolist():
            place = int(at[k])
            while place < len(self.hashes) and self.hashes[place] == hashes[k]:
                if self.words[self.hash_rows[place]] == wanted[k]:
                    out[k] = self.hash_rows[place]
                place += 1
        return out


@dataclass(frozen=True)
class Index:
    """Shards as a table, and what they were built with."""

    shards: DataFrame | None
    documents: int
    all_terms: int


def _size_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    documents = all_terms = 0
    for batch in batches:
        for text in column_values(batch, "text"):
            n = len(terms(text))
            documents += n > 0
            all_terms += n
    yield pa.RecordBatch.from_arrays([pa.array([documents]), pa.array([all_terms])], names=["documents", "all_terms"])


def build_index(
    documents: DataFrame, shard_points: int = SHARD_POINTS, shard_documents: int = SHARD_DOCUMENTS
) -> Index:
    """Indexes all rows and all their terms; texts do not leave the task that reads them."""
    small_batches(documents.sparkSession)
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), utf8("text").alias("text"))
    sums = rows.mapInArrow(_size_batches, "documents long, all_terms long")
    n, length = sums.agg(F.coalesce(F.sum("documents"), F.lit(0)), F.coalesce(F.sum("all_terms"), F.lit(0))).first()
    if not n:
        return Index(None, 0, 0)
    built = rows.mapInArrow(_build_batches(n, length, shard_points, shard_documents), INDEX)
    return Index(stored(built, "treaps", compression="zstd"), n, length)


# Queries

@dataclass(frozen=True)
class _Block:
    """Some queries: all their terms, and the numbers of each query's terms."""

    wanted: list[bytes]
    hashes: np.ndarray
    queries: list[np.ndarray]


def _block(texts: list[bytes | None]) -> _Block:
    number: dict[bytes, int] = {}
    queries = [
        np.array(sorted({number.setdefault(t, len(number)) for t in terms(text)}), np.int64) for text in texts
    ]
    hashes = np.fromiter((xxhash.xxh64_intdigest(t) for t in number), np.uint64, len(number))
    return _Block(list(number), hashes, queries)


def _shards_of(batches: Iterator[pa.RecordBatch]) -> Iterator[Shard]:
    for batch in batches:
        for row in batch.to_pylist():
            yield Shard(row)


def _holding_batches(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = shared.value
        total = np.zeros(len(block.wanted), np.int64)
        for shard in _shards_of(batches):
            rows = shard.rows_of(block.wanted, block.hashes)
            total += np.where(rows >= 0, shard.holding[rows], 0)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total))), pa.array(total)], names=["term", "n"])

    return run


def _best_batches(shared, weighted, top: int, steps: int | None):
    """Each query's best rows of all shards of a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, (weights, least) = shared.value, weighted.value
        kept: list[list[tuple]] = [[] for _ in block.queries]
        for shard in _shards_of(batches):
            rows = shard.rows_of(block.wanted, block.hashes)
            for start in range(0, len(block.queries), TOGETHER):
                part = [numbers[rows[numbers] >= 0] for numbers in block.queries[start : start + TOGETHER]]
                asked = Asked.of([(rows[there], weights[there]) for there in part])
                floor = least[start : start + len(part)].copy()
                for q in range(len(part)):
                    own = kept[start + q]
                    if len(own) == top:
                        floor[q] = max(floor[q], own[-1][0])
                found = best(shard.treap, len(shard.doc_ids), asked, top, floor, steps)
                for q, score, column in zip(*(x.tolist() for x in found), strict=True):
                    kept[start + q].append((score, shard.doc_ids[column]))
                for q in np.unique(found[0]).tolist():
                    kept[start + q] = sorted(kept[start + q], key=lambda x: (-x[0], x[1] is None, x[1] or 0))[:top]
        out = [(q, doc, score) for q, own in enumerate(kept) for score, doc in own]
        columns = list(zip(*out, strict=True)) or [(), (), ()]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["query", "doc_id", "score"])

    return run


def _answers(index: Index, texts: list[bytes | None], top: int, seed_steps: int) -> DataFrame:
    """``query, doc_id, score``: for each query the best rows of every task, the best of all among them."""
    spark = index.shards.sparkSession
    block = _block(texts)
    shared = spark.sparkContext.broadcast(block)
    # A row is a shard of some megabytes.
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1")
    counted = index.shards.mapInArrow(_holding_batches(shared), "term long, n long").groupBy("term").agg(F.sum("n").alias("n"))
    weights = np.zeros(len(block.wanted), np.int64)
    for term, n in counted.collect():  # the terms of a block of queries
        weights[term] = weight(index.documents, n)
    ddl = "query long, doc_id long, score long"
    least = np.ones(len(texts), np.int64)
    first = spark.sparkContext.broadcast((weights, least))
    seeds = stored(index.shards.mapInArrow(_best_batches(shared, first, top, seed_steps), ddl), "seeds")
    order = Window.partitionBy("query").orderBy(F.desc("score"))
    worst = seeds.withColumn("place", F.row_number().over(order)).filter(F.col("place") == top).select("query", "score")
    for query, score in worst.collect():  # one row a query of the block
        least[query] = score
    second = spark.sparkContext.broadcast((weights, least))
    return stored(index.shards.mapInArrow(_best_batches(shared, second, top, None), ddl), "answers")


def search(
    index: Index, queries: DataFrame, key: str, top: int = TOP, block: int = QUERY_BLOCK, seed_steps: int = SEED_STEPS
) -> DataFrame:
    """``key, rank, doc_id, score`` for every row of ``queries`` and its best rows of the index.

    The queries pass the driver in blocks.  A query's terms count once each.
    Scores are above 0; equal ones are in the order of doc_id, null last.  Each
    row of the queries is a query of its own, also if its key or text repeats or
    is null; one without terms has no answer.  Indexed rows count each for
    itself, whatever their ids.
    """
    spark = queries.sparkSession
    kind = queries.schema[key].dataType.simpleString()
    schema = f"`{key}` {kind}, query long, doc_id long, score long"
    parts: list[DataFrame] = []
    held: list[tuple] = []

    def answer() -> None:
        names = spark.createDataFrame([(k, n) for n, (k, _) in enumerate(held)], f"`{key}` {kind}, query long")
        found = _answers(index, [text for _, text in held], top, seed_steps)
        order = Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
        ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
        parts.append(ranked.join(names, "query").select(F.col(f"`{key}`"), "rank", "doc_id", "score"))

    if index.shards is not None:
        for row in queries.select(F.col(f"`{key}`").alias("k"), utf8("text").alias("t")).toLocalIterator():
            held.append((row.k, row.t))
            if len(held) == block:
                answer()
                held = []
        if held:
            answer()
    if not parts:
        return spark.createDataFrame([], schema.replace("query long", "rank int"))
    out = parts[0]
    for part in parts[1:]:
        out = out.union(part)
    return out
