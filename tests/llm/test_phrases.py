import random
import re
from collections import Counter

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from helpers import awkward, documents

from revtide.llm import phrases
from revtide.llm.oracle import PHRASES
from revtide.llm.queries import QUERIES


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def slow_counts(rows, most=5):
    """Every phrase of every piece, by language, and the words."""
    f, n = Counter(), Counter()
    for _, text, lang, _ in rows:
        lang = lang or "und"
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", lower(text)):
            found = re.findall("[^ \t]+", piece)
            n[lang] += len(found)
            for k in range(1, most + 1):
                for i in range(len(found) - k + 1):
                    f[lang, " ".join(found[i : i + k])] += 1
    return f, n


def slow_collocations(rows, support, top):
    f, n = slow_counts(rows)
    candidates = {p: a for p, a in f.items() if a >= support and " " in p[1]}
    out = {}
    for (lang, phrase), a in candidates.items():
        if any(
            q != phrase and other == lang and f" {phrase} " in f" {q} " and 100 * b >= 100 * a
            for (other, q), b in candidates.items()
        ):
            continue
        found = phrase.split(" ")
        cuts = []
        for k in range(1, len(found)):
            l, r = f[lang, " ".join(found[:k])], f[lang, " ".join(found[k:])]
            cuts.append((1000 * a * n[lang] // (l * r), k, l, r))
        score, _, l, r = min(cuts)
        out.setdefault(lang, []).append((-score, -a, phrase.encode(), l, r))
    return {
        (lang, rank, p.decode(), -a, l, r, n[lang], -score)
        for lang, found in out.items()
        for rank, (score, a, p, l, r) in enumerate(sorted(found)[:top], 1)
    }


def corpus(docs=120):
    rng = random.Random(8)
    fixed = ["in spite of", "of the order of", "a b a b a", "New York City", "à la carte", "x x x x"]
    rows = []
    for d in range(docs):
        parts = []
        for _ in range(rng.randint(0, 25)):
            parts.append(rng.choice(fixed) if rng.random() < 0.4 else " ".join(f"w{rng.randint(0, 40)}" for _ in range(3)))
            parts.append(rng.choice([" ", "  ", "\t", ". ", ",", "\n", "?! ", " "]))
        rows.append((d, "".join(parts), rng.choice(["en", "de", None]), "s"))
    return rows


@pytest.mark.parametrize("support, shard_words", [(10, 1 << 22), (10, 150), (3, 40), (25, 600)])
def test_against_all_phrases(spark, support, shard_words):
    rows = corpus()
    got = phrases.collocations(documents(spark, rows), top=30, support=support, shard_words=shard_words)
    expected = slow_collocations(rows, support, 30)
    assert {tuple(r) for r in got.collect()} == expected and len(expected) > 20


def test_candidates_lose_nothing_and_prune(spark):
    """Local supports fall with the shard; what is missing in some shards may still be frequent in all."""
    rows = corpus(400)
    f, n = slow_counts(rows)
    frequent = {p for p, a in f.items() if a >= 40}
    got = phrases.phrase_counts(documents(spark, rows).repartition(7), support=40, shard_words=200)
    assert {(r.lang, r.phrase): (r.f, r.n) for r in got.collect()} == {p: (f[p], n[p[0]]) for p in frequent}
    assert phrases.local_support(10, 1000, 100) == 1 and phrases.local_support(11, 1000, 100) == 2


class Shared:
    value = np.full(phrases.FILTER_BITS // 64, -1, np.int64)  # everything passes


def batches(rows, **more):
    texts = [r for r in rows if r[2]]
    for k in range(0, len(texts), 16):
        part = texts[k : k + 16]
        columns = {"lang": [r[2] for r in part], "text": [r[1].encode() for r in part]}
        columns |= {name: [of[r[2]] for r in part] for name, of in more.items()}
        yield pa.RecordBatch.from_pydict(columns)


def test_a_task_adds_up_its_shards():
    """Each phrase leaves a task once, however many shards the task has."""
    rows = [r for r in corpus(200) if r[2]]
    f, n = slow_counts(rows)
    out = [r for b in phrases._count_batches(Shared, 5, 40)(batches(rows)) for r in b.to_pylist()]
    assert {(r["lang"], r["phrase"]): r["n"] for r in out} == f and len(out) == len(f)
    out = [r for b in phrases._count_batches(Shared, 5, 40, 300)(batches(rows)) for r in b.to_pylist()]
    again = Counter()
    for r in out:
        again[r["lang"], r["phrase"]] += r["n"]
    assert again == f and len(out) > len(f)  # handed on in between

    for held in (1 << 20, 200):
        mined = [r for b in phrases._mine_batches(60, 5, 40, held)(batches(rows, of=n)) for r in b.to_pylist()]
        known = {(r["lang"], r["hash"]) for r in mined if r["hash"] is not None}
        if held > 200:
            assert len(known) == sum(r["hash"] is not None for r in mined)
            # The task has the whole corpus, so its share is the whole support.
            assert {r["silent"] for r in mined} == {59} and all(r["n"] >= 60 for r in mined if r["hash"] is not None)
        assert len(known) >= sum(a >= 60 for a in f.values()) > 10


def test_tasks_do_not_follow_partitions(spark, monkeypatch):
    """A pass has the tasks it is given, and loses no phrase by it."""
    rows = corpus(300)
    f, n = slow_counts(rows)
    sizes = {}

    def stored(frame, label, keep=phrases.stored):
        if label == "mined":
            sizes[label] = frame.rdd.getNumPartitions()
        return keep(frame, label)

    monkeypatch.setattr(phrases, "stored", stored)
    got = phrases.phrase_counts(documents(spark, rows).repartition(24), support=30, shard_words=100, tasks=3)
    assert {(r.lang, r.phrase): (r.f, r.n) for r in got.collect()} == {p: (a, n[p[0]]) for p, a in f.items() if a >= 30}
    assert sizes["mined"] <= 3


def test_long_products(spark):
    big = 10**12
    counts = spark.createDataFrame(
        [("en", "a b", big, 10**15), ("en", "a", 2 * big, 10**15), ("en", "b", 3 * big, 10**15)],
        "lang string, phrase string, f long, n long",
    )
    row = phrases.scored(counts).first()
    assert row.score == 1000 * big * 10**15 // (6 * big * big)


def test_query_and_awkward_rows(spark, tmp_path):
    frame = awkward(spark)
    frame.write.parquet(f"{tmp_path}/documents.parquet")
    got = QUERIES["op12_phrase_collocations"](spark, str(tmp_path))
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    tables = duckdb.connect()
    tables.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    assert sorted(map(tuple, got.collect())) == sorted(tables.execute(PHRASES).fetchall())
    assert phrases.collocations(frame.limit(0)).count() == 0
