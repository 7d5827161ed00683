import random

import numpy as np
import pytest
from helpers import awkward, documents, words

from revtide.llm import minhash
from revtide.llm.queries import QUERIES


def ascii_lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def shingles(text):
    found = words(ascii_lower(text))
    if len(found) < 4:
        return {tuple(found)} if found else set()
    return {tuple(found[i : i + 4]) for i in range(len(found) - 3)}


def slow_groups(rows):
    """Smallest doc_id reachable over pairs of Jaccard similarity 0.8."""
    sets = {d: shingles(t) for d, t in rows}
    root = {d: d for d in sets}

    def find(d):
        while root[d] != d:
            d = root[d]
        return d

    for a in sets:
        for b in sets:
            if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {d: find(d) for d in sets}


def corpus(bases=25):
    """Copies with changed, added and lost words on either side of the limit, chains, a shared notice and exact copies."""
    rng = random.Random(31)
    word = lambda: f"w{rng.randint(0, 3000)}"
    notice = [word() for _ in range(60)]
    rows = []
    for _ in range(bases):
        base = [word() for _ in range(rng.randint(3, 200))]
        for _ in range(6):
            text = list(base)
            for _ in range(rng.randint(0, 1 + len(base) // 50)):
                text[rng.randrange(len(text))] = word()
            if rng.random() < 0.5:
                text += [word() for _ in range(rng.randint(0, len(base) // 4))]
            rows.append((len(rows), " ".join(text)))
        for _ in range(2):
            base = base[len(base) // 8 :] + [word() for _ in range(len(base) // 8)]
            rows.append((len(rows), "\n".join(base).upper()))
    rows += [(len(rows) + i, " ".join([*notice, *(word() for _ in range(20))])) for i in range(60)]
    rows += [(len(rows) + i, rows[7][1]) for i in range(30)]
    ids = list(range(len(rows)))
    rng.shuffle(ids)
    return [(ids[d], t) for d, t in rows]


def slow_sketch(items, bins):
    """The rounds one by one, for one set."""
    least = [None] * bins
    for turn in range(2 * bins):
        if None not in least:
            break
        for x in items:
            h = int(minhash._mixed(np.array([x], np.uint64) + minhash._seed(turn))[0])
            place = (h >> 44) * bins >> 20 if turn < bins else turn - bins
            value = (turn << 44) | (h & ((1 << 44) - 1))
            if least[place] is None or value < least[place]:
                least[place] = value
    return least


def test_sketch_against_single_rounds():
    rng = np.random.default_rng(2)
    sets = [np.unique(rng.integers(0, 1 << 63, n).astype(np.uint64)) for n in (0, 1, 2, 7, 40, 300)]
    got = minhash.sketches(sets, 24)
    assert (got[0] == minhash._EMPTY).all()
    for row, items in zip(got[1:], sets[1:], strict=True):
        assert row.tolist() == slow_sketch(items.tolist(), 24)


@pytest.mark.parametrize("share", [0.3, 0.8, 0.95])
def test_agreement_is_concentrated_around_the_similarity(share):
    rng = np.random.default_rng(7)
    agree = []
    for _ in range(60):
        items = np.unique(rng.integers(0, 1 << 63, 400).astype(np.uint64))
        common = int(share * len(items))
        half = common + (len(items) - common) // 2
        pair = minhash.sketches([items[:half], np.concatenate([items[:common], items[half:]])])
        agree.append((pair[0] == pair[1]).mean())
    assert abs(np.mean(agree) - share) < 0.02 and np.std(agree) < 0.04


def test_bound_never_excludes_a_similar_pair():
    rng = np.random.default_rng(3)
    pruned = 0
    for _ in range(400):
        n = int(rng.integers(1, 300))
        a = np.unique(rng.integers(0, 1 << 63, n).astype(np.uint64))
        keep = rng.random(len(a)) < rng.choice([0.2, 0.85, 0.95])
        b = np.unique(np.concatenate([a[keep], rng.integers(0, 1 << 63, int(rng.integers(0, 1 + n // 5))).astype(np.uint64)]))
        if not len(b):
            continue
        counts = [np.frombuffer(minhash.cells(s), "<u2") for s in (a, b)]
        may = minhash.may_be_similar(len(a), counts[0], np.array([len(b)]), counts[1][None, :], 80)[0]
        pruned += not may
        assert may or not minhash.similar(a, b)
    assert pruned > 50


@pytest.mark.parametrize("first_bands, block_rows", [(6, 2048), (0, 7), (1, 3)])
def test_components_against_all_pairs(spark, first_bands, block_rows):
    rows = corpus()
    expected = slow_groups(rows)
    assert 40 < len(set(expected.values())) < len(rows) - 30
    found = minhash.near_duplicates(documents(spark, rows), first_bands=first_bands, block_rows=block_rows).collect()
    assert {r.doc_id: r.component_id for r in found} == expected
    assert {r.doc_id: r.n_shingles for r in found} == {d: len(shingles(t)) for d, t in rows}


def test_one_notice_in_many_texts_makes_few_pairs(spark):
    """Texts that share a notice of a third of their shingles, thousands of them: no pairs by the square."""
    rng = random.Random(5)
    notice = " ".join(f"n{i}" for i in range(30))
    rows = [(i, f"{notice} " + " ".join(f"w{rng.randint(0, 10**6)}" for _ in range(60))) for i in range(3000)]
    pairs, confirm = [], minhash._Verification.confirm

    def counted(self, candidates):
        confirm(self, candidates)
        pairs.append(self.tried.count())

    minhash._Verification.confirm = counted
    try:
        found = minhash.near_duplicates(documents(spark, rows)).collect()
    finally:
        minhash._Verification.confirm = confirm
    assert all(r.component_id == r.doc_id for r in found)
    assert pairs[-1] < 3 * len(rows)


def test_query_and_awkward_rows(spark, tmp_path):
    frame = awkward(spark)
    frame.write.parquet(f"{tmp_path}/documents.parquet")
    got = QUERIES["op13_minhash_near_dedup"](spark, str(tmp_path))
    assert got.columns == ["doc_id", "n_shingles", "component_id", "kept"]
    rows = sorted(map(tuple, got.collect()), key=repr)
    texts = sorted(((r.doc_id, r.text) for r in frame.collect()), key=repr)
    assert [r[0] for r in rows] == sorted((d for d, _ in texts), key=repr)
    by_id = {}
    for doc, n, component, kept in rows:
        by_id.setdefault(doc, []).append((n, component, kept))
    assert by_id[1] == [(0, 1, True)] and by_id[2] == [(0, 2, True)] and by_id[3] == [(0, 3, True)]
    assert by_id[4] == [(1, 4, True)] * 3 and by_id[None] == [(1, None, True)]
    assert [c for _, c, _ in by_id[5] + by_id[6]] == [5, 5] and [k for _, _, k in by_id[8]] == [False]
    assert minhash.near_duplicates(frame.limit(0)).count() == 0


def test_rows_repeated_many_times(spark):
    base = " ".join(f"w{i}" for i in range(60))
    rows = [(7, base)] * 500 + [(3, base + " more"), (9, "another text of five words")]
    found = minhash.near_duplicates(documents(spark, rows)).collect()
    assert len(found) == len(rows)
    assert {r.component_id for r in found if r.doc_id in (3, 7)} == {3}


def test_rows_grow_with_members_and_not_with_pairs(spark, monkeypatch):
    # All texts share 174 of their 200 shingles: below the limit, but mostly within the bound.
    drawn = random.Random(5)
    base = " ".join(f"w{i}" for i in range(177))
    rows = [(d, base + "".join(f" x{drawn.randrange(10**9)}" for _ in range(26))) for d in range(400)]
    rows += [(d + 1000, text.replace(" w5 ", " w5x ")) for d, text in rows[:5]]
    sizes, stored = {}, minhash.stored

    def counted(frame, label, **options):
        out = stored(frame, label, **options)
        sizes[label] = sizes.get(label, 0) + out.count()
        return out

    monkeypatch.setattr(minhash, "stored", counted)
    found = {r.doc_id: r.component_id for r in minhash.near_duplicates(documents(spark, rows)).collect()}
    assert found == {d: d % 1000 for d, _ in rows}
    members = len(rows) * minhash.BANDS
    assert sizes["buckets"] <= members and sizes["pairs"] <= members
    assert sizes["links"] < len(rows) and sizes.get("live", 0) <= sizes["buckets"]
