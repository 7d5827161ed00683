import math
import random
import re
from collections import Counter
from pathlib import Path

import duckdb
import numpy as np
import pytest
from helpers import awkward, documents

from revtide.llm import treap_search as ts
from revtide.llm.oracle import RANKED
from revtide.llm.queries import QUERIES

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def slow_terms(text):
    return [re.sub("[A-Z]", lambda m: m[0].lower(), t) for t in TERM.findall(text or "")]


def slow_search(rows, items, top=10):
    counts = [(d, Counter(slow_terms(t))) for d, t in rows]
    counts = [(d, c) for d, c in counts if c]
    n, length = len(counts), sum(c.total() for _, c in counts)
    df = Counter(t for _, c in counts for t in c)
    out = set()
    for item, text in items:
        found = []
        for doc, c in counts:
            m = 100 - 90 + (90 * c.total() * n) // length
            score = sum(
                math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * ((1000000000 * c[t]) // (1000 * c[t] + 8 * m))
                for t in set(slow_terms(text))
                if t in c
            )
            if score > 0:
                found.append((-score, doc))
        out |= {(item, rank, doc, -score) for rank, (score, doc) in enumerate(sorted(found)[:top], 1)}
    return out


def corpus(n=500):
    rng = random.Random(4)
    words = [f"Wort{i}" for i in range(300)] + ["the", "of", "Straße", "日本", "x"] * 30
    rows = [(1000 - i, " ".join(rng.choice(words) for _ in range(rng.randint(0, 90)))) for i in range(n)]
    rows += [(2000 + i, rows[3][1]) for i in range(25)] + [(3000, None), (3001, ""), (3002, "?! --")]
    items = [(i, " ".join(rng.choice(words) for _ in range(rng.randint(1, 30)))) for i in range(20)]
    items += [(50, rows[3][1]), (51, None), (52, "..."), (53, "unheard-of"), (54, "the the THE the")]
    return rows, items


def test_treap_holds_every_point_once_and_falls():
    rng = np.random.default_rng(1)
    places = rng.choice(64 * 64, 700, replace=False)
    row, column, value = places // 64, places % 64, rng.integers(1, 50, 700)
    treap = ts.build(row, column, value, 6)
    assert sum(map(len, treap.top)) == 700
    for level in range(len(treap.top) - 1):
        parents = np.repeat(np.arange(len(treap.top[level])), np.bitwise_count(treap.children[level]))
        assert (treap.top[level + 1] <= treap.top[level][parents]).all() and len(parents) == len(treap.top[level + 1])
    grid = np.zeros((64, 64), np.int64)
    grid[row, column] = value
    every = np.arange(64)
    for r in range(64):
        asked = ts.Asked.of([(np.array([r]), np.ones(1, np.int64))])
        none = np.zeros(64, np.int64)
        good, sums = ts.scores(treap, 0, none, every, every, none, none, asked)
        assert good.tolist() == np.flatnonzero(grid[r]).tolist() and sums.tolist() == grid[r][grid[r] > 0].tolist()


@pytest.mark.parametrize("seed", range(8))
def test_best_first_against_all_columns(seed):
    rng = np.random.default_rng(seed)
    rows, columns = int(rng.integers(1, 200)), int(rng.integers(1, 3000))
    full = rng.random((rows, columns)) < rng.choice([0.01, 0.1, 0.4])
    row, column = np.nonzero(full)
    value = rng.integers(1, int(rng.choice([3, 10**6])), len(row))
    treap = ts.build(row, column, value, max(rows - 1, columns - 1).bit_length())
    grid = np.zeros((rows, columns), np.int64)
    grid[row, column] = value
    queries = []
    for _ in range(10):
        asked = rng.choice(rows, int(rng.integers(0, min(rows, 30) + 1)), replace=False)
        queries.append((asked, rng.integers(0, 9, len(asked))))
    least, expected = np.ones(10, np.int64), []
    for q, (asked, weights) in enumerate(queries):
        sums = weights @ grid[asked] if len(asked) else np.zeros(columns, np.int64)
        order = sorted(range(columns), key=lambda c: (-sums[c], c))[:7]
        if q % 3 == 1 and sums[order[-1]] > 0:
            least[q] = sums[order[2 if len(order) > 2 else 0]]  # a score that some columns reach
        expected += [(q, int(sums[c]), c) for c in order if sums[c] >= least[q]]
    found = ts.best(treap, columns, ts.Asked.of(queries), 7, least)
    assert list(zip(*(x.tolist() for x in found), strict=True)) == expected


def test_few_ranges_are_split(monkeypatch):
    """Where few columns hold the rare terms, the search leaves the others alone."""
    rng = np.random.default_rng(3)
    full = rng.random((512, 8192)) < 0.02
    full[40:, 100:] &= rng.random((472, 8092)) < 0.05
    full[300:310, 50:60] = True
    row, column = np.nonzero(full)
    treap = ts.build(row, column, rng.integers(500, 1000, len(row)), 13)
    scored, scores = [], ts.scores
    monkeypatch.setattr(ts, "scores", lambda t, k, least, new, *more: scored.append(len(new)) or scores(t, k, least, new, *more))
    asked = ts.Asked.of([(np.arange(300, 310), np.full(10, 9))])
    assert len(ts.best(treap, 8192, asked, 10, np.ones(1, np.int64))[0]) == 10
    assert 10 <= sum(scored) < 1200


@pytest.mark.parametrize("points, docs, block, steps", [(1 << 20, 1 << 14, 4096, 5), (700, 1 << 14, 7, 1), (1 << 20, 9, 100, 0)])
def test_search_against_all_scores(spark, points, docs, block, steps):
    rows, items = corpus()
    index = ts.build_index(documents(spark, rows).repartition(3), points, docs)
    queries = spark.createDataFrame(items, "item_id long, text string")
    got = ts.search(index, queries, "item_id", block=block, seed_steps=steps)
    assert {tuple(r) for r in got.collect()} == slow_search(rows, items)


def test_query_and_awkward_rows(spark, tmp_path):
    frame = awkward(spark)
    frame.write.parquet(f"{tmp_path}/documents.parquet")
    items = [(1, "same text"), (2, None), (None, "word3 word4"), (4, "one"), (4, "TWO"), (6, "é́ nul")]
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    got = QUERIES["op11_treap_search"](spark, str(tmp_path)).collect()
    assert {(r.item_id, r.rank, r.doc_id) for r in got if r.item_id == 1} == {(1, 1, 7), (1, 2, 8)}
    assert {(r.rank, r.doc_id) for r in got if r.item_id == 4} == {(1, 4), (2, 4)}
    assert {(r.rank, r.doc_id) for r in got if r.item_id is None} == {(1, 5), (2, 6)}
    assert not [r for r in got if r.item_id == 2]
    empty = ts.build_index(frame.limit(0))
    assert ts.search(empty, spark.createDataFrame(items, "item_id long, text string"), "item_id").count() == 0
    index = ts.build_index(frame)
    assert ts.search(index, spark.createDataFrame([], "item_id long, text string"), "item_id").count() == 0


@pytest.mark.skipif(not Path("/root/testdata/sf0.001").exists(), reason="sample tables not present")
def test_sql_says_the_same_as_the_slow_search():
    tables = duckdb.connect()
    rows, items = corpus(60)
    tables.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    tables.execute("CREATE TABLE benchmark (item_id BIGINT, text VARCHAR)")
    tables.executemany("INSERT INTO documents VALUES (?, ?)", rows)
    tables.executemany("INSERT INTO benchmark VALUES (?, ?)", items)
    assert set(tables.execute(RANKED).fetchall()) == slow_search(rows, items)
