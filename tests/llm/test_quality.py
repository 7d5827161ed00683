import random
from collections import Counter

from helpers import awkward, documents, words

from revtide.llm import quality
from revtide.llm.queries import QUERIES


def slow(text):
    text = text or ""
    found = words(text)
    windows = [tuple(found[i : i + 3]) for i in range(len(found) - 2)]
    times = Counter(windows)
    repeated = {i + k for i, w in enumerate(windows) if times[w] > 1 for k in range(3)}
    seen, again = set(), 0
    for line in text.split("\n"):
        if words(line):
            again += line in seen
            seen.add(line)
    return (
        len(found), sum(map(len, found)), sum(c in "#*$%&|<>" for c in text), again, len(repeated),
        len(found) < 50 or 100 * len(repeated) > 50 * len(found),
    )


def corpus():
    rng = random.Random(11)

    def line(n=12):
        return " ".join(f"v{rng.randint(0, 5000)}é" for _ in range(n))

    rows = []
    for i in range(300):
        text = "\n".join([("Shared  banner LINE" if i % 2 else "shared banner line"), *(line() for _ in range(6))])
        rows.append((i, text, "en", "a" if i % 3 else "b"))
    flat = "\n".join(["shared banner line " * 3, *["menu home about contact " * 9] * 1, line(20)])
    rows += [(1000 + i, flat + f" tail{i}", "en", "a") for i in range(60)]
    copied = "\n".join(line() for _ in range(8))
    rows += [(2000 + i, copied, "en", "a") for i in range(90)]
    rows += [(3000, "spam ham egg " * 60, "en", "b"), (3001, "# a $ b | c\n\n# a $ b | c\n" + line(70), "en", "c")]
    return rows


def test_quality_against_a_plain_count(spark):
    rows = corpus()
    got = {r.doc_id: r for r in quality.quality(documents(spark, rows), floor=20, share=0.05).collect()}
    texts = {}
    for _, text, _, host in rows:
        texts.setdefault(host, set()).add(text)
    norm = lambda s: " ".join(words(s.lower()))  # noqa: E731  the fixture has ASCII capitals only
    limits = {h: max(20, 0.05 * len(t)) for h, t in texts.items()}
    holders = {h: Counter(x for t in ts for x in {norm(s) for s in t.split("\n") if words(s)}) for h, ts in texts.items()}
    for doc, text, _, host in rows:
        r = got[doc]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == slow(text)
        lost = sum(len(words(s)) for s in text.split("\n") if words(s) and holders[host][norm(s)] > limits[host])
        assert r.removed_words == lost
        assert r.kept == (not r.base_failed and 100 * lost <= 50 * r.n_words)
    assert not any(got[1000 + i].kept for i in range(60))  # depleted
    assert all(got[2000 + i].kept for i in range(90))  # copies do not condemn each other


def test_kept_documents_lose_the_shared_lines(spark):
    frame = documents(spark, corpus())
    kept = {r.doc_id: r for r in quality.kept_documents(frame, floor=20, share=0.05).collect()}
    assert 1000 not in kept and 3000 not in kept
    assert "anner" not in kept[5].text and len(words(kept[5].text)) == 72
    assert kept[5].n_chars == len(kept[5].text)
    assert kept[2000].text == frame.filter("doc_id = 2000").first().text


def test_awkward_rows(spark):
    frame = awkward(spark)
    got = quality.quality(frame).collect()
    assert len(got) == frame.count()
    for r in got:
        if r.doc_id in (1, 2, 3):
            assert (r.n_words, r.kept, r.base_failed) == (0, False, True)
    assert sorted(quality.kept_documents(frame).columns) == sorted(frame.columns)
    assert quality.quality(frame.limit(0)).count() == 0 and quality.kept_documents(frame.limit(0)).count() == 0


def test_query_columns(spark, tmp_path):
    documents(spark, corpus()).write.parquet(f"{tmp_path}/documents.parquet")
    rows = QUERIES["op10_quality_rules"](spark, str(tmp_path)).collect()
    assert len(rows) == len(corpus())
