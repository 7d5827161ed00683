import math
from collections import Counter, defaultdict

import pytest
from helpers import awkward, documents, words

from revtide.llm import mixing


def corpus():
    sizes = {"big": 900, "mid": 200, "small": 40, None: 15}
    rows, n = [], 0
    for source, count in sizes.items():
        for _ in range(count):
            rows.append((n, " ".join(["w"] * (1 + n * 7 % 23)), "en", source))
            n += 1
    return rows


def test_exponent_meets_entropy_and_repetition():
    tokens = [90_000, 5_000, 300]
    for target in (0.3, 0.6, 0.9):
        x = mixing.fit_exponent(tokens, sum(tokens), target, 1e9)
        assert mixing.entropy(mixing.weights_at(x, tokens)) == pytest.approx(target * math.log(3), abs=1e-6)
    x = mixing.fit_exponent(tokens, sum(tokens), 0.9, 4.0)
    most = max(w * sum(tokens) / t for w, t in zip(mixing.weights_at(x, tokens), tokens, strict=True))
    assert most == pytest.approx(4.0, rel=1e-6)
    assert mixing.fit_exponent([5, 5], 10) == 1.0 and mixing.fit_exponent([7], 7) == 1.0 and mixing.fit_exponent([0, 0], 0) == 1.0


def test_stream(spark):
    rows = corpus()
    budget = 9000
    got = mixing.mix(documents(spark, rows), budget=budget, block_tokens=500, slice_rows=16).collect()
    tokens = {d: len(words(t)) for d, t, *_ in rows}
    sources = {d: s for d, _, _, s in rows}
    held = Counter()
    for d, s in sources.items():
        held[s] += tokens[d]
    keys = sorted(held, key=str)
    weights = dict(zip(keys, mixing.weights_at(mixing.fit_exponent([held[k] for k in keys], budget), [held[k] for k in keys]), strict=True))
    by_source = defaultdict(list)
    for r in got:
        assert r.tokens == tokens[r.doc_id] and r.source == sources[r.doc_id]
        by_source[r.source].append(r)
    for source, drawn in by_source.items():
        quota = round(weights[source] * budget)
        drawn.sort(key=lambda r: r.first_token)
        at = 0
        for r in drawn:  # gapless, and every copy starts within the quota
            assert r.first_token == at and at < quota
            assert r.block == math.floor(at / max(weights[source] * 500, 1.0))
            at += r.tokens
        assert at >= quota
        copies = Counter(r.doc_id for r in drawn)
        times = [copies[d] for d in sources if sources[d] == source]
        assert max(times) - min(times) <= 1
        assert [r.copy for r in drawn] == sorted(r.copy for r in drawn)
    again = mixing.mix(documents(spark, rows[::-1]).repartition(3), budget=budget, block_tokens=500, slice_rows=16)
    assert sorted(map(tuple, again.collect()), key=repr) == sorted(map(tuple, got), key=repr)


def test_documents_follow_the_stream(spark):
    rows = [*corpus(), *corpus()[:50]]
    frame = documents(spark, rows)
    drawn = Counter(r.doc_id for r in mixing.mix(frame, budget=9000).collect())
    kept = mixing.mixed_documents(frame, budget=9000)
    assert kept.columns == frame.columns
    assert Counter(r.doc_id for r in kept.collect()) == drawn


def test_awkward_rows(spark):
    frame = awkward(spark)
    got = mixing.mix(frame)
    assert {r.doc_id for r in got.filter("tokens = 0").collect()} == {1, 2, 3}
    assert mixing.mixed_documents(frame).columns == frame.columns
    assert mixing.mix(frame.limit(0)).count() == 0 and mixing.mixed_documents(frame.limit(0)).count() == 0
    hot = documents(spark, [(1, "a b c", "en", "s")] * 300 + [(2, "d e", "en", "t")])
    assert mixing.mix(hot).filter("doc_id = 1").count() >= 1
