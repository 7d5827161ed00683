import hashlib
import random
import re

import pytest
from helpers import awkward, documents

from revtide.llm import pii

# The contract's patterns as they stand.
PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for k, c in enumerate(reversed(digits)):
        double = int(c) * (1 + k % 2)
        total += double - 9 * (double > 9)
    return total % 10 == 0


def valid(kind, value):
    digits = re.sub(r"\D", "", value)
    if kind == "ip":
        return all(int(p) <= 255 for p in value.split("."))
    if kind == "card":
        return 14 <= len(digits) <= 19 and luhn(digits)
    return kind == "email" or 10 <= len(digits) <= 15


def slow(text):
    spans = [
        (m.start(), rank, m.end(), kind)
        for rank, (kind, pattern) in enumerate(PLAIN.items())
        for m in re.finditer(pattern, text or "")
        if valid(kind, m[0])
    ]
    joined = ",".join(f"{kind}:{start}:{end}" for start, _, end, kind in sorted(spans))
    return [sum(s[3] == k for s in spans) for k in PLAIN], joined


TRICKY = [
    "a@b.c@d.e a@b.c.d_e@x.y x@y a@b@c.d ..a@-.- a@b..c é+1@é.fr",
    "1.2.3.4.5.6.7.8 256.1.1.1 001.002.003.0255 1.2.3 .1.2.3.4. 99999999999999999999.1.1.1 0.0.0.0",
    "4111 1111 1111 1111 4111-1111-1111-1111 4111  1111 1111 1111 49927398716 4111111111111111 1 2 3",
    "+1 (017) 555-7713 +1 2 3 +123456789012345 +1234567890123456 ++1-234-567-8901+44 20 7946 0958",
    "\U0001f600 mail me@x.org \U0001f600 1.1.1.1",
    "4" * 50 + " " + "12-" * 40 + "3", "0 " * 3000, "a" * 3000 + "@", "1." * 2000, "+1" * 500,
]


def test_base_spans_against_the_patterns(spark):
    rng = random.Random(9)
    alphabet = ["@", ".", "+", "-", " ", "(", ")", "_", "a", "Z", "é", *"0123456789", "\n"]
    texts = [*TRICKY, *("".join(rng.choices(alphabet, k=rng.randint(0, 120))) for _ in range(400)), None, ""]
    got = {r.doc_id: r for r in pii.digests(documents(spark, list(enumerate(texts)))).collect()}
    for k, text in enumerate(texts):
        counts, joined = slow(text)
        r = got[k]
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == counts, text
        assert r.base_sha256 == hashlib.sha256(joined.encode()).hexdigest(), text
        assert {s for s in joined.split(",") if s} <= set(r.spans.split(","))


def test_weak_supervision_adds_spans(spark):
    rng = random.Random(3)
    rows = []
    for i in range(300):
        filler = " ".join(rng.choice(["some", "plain", "words", "here"]) for _ in range(20))
        if i % 5 == 0:
            secret = "".join(rng.choices("0123456789abcdef", k=40))
            filler += f' token = "{secret}" and more'
        if i % 7 == 0:
            filler += f" ssn {rng.randint(100, 600)}-{rng.randint(10, 99)}-{rng.randint(1000, 9999)} end"
        if i % 11 == 0:
            filler += " " + "longwordwithoutanydigitsatall" * 2
        rows.append((i, filler))
    got = {r.doc_id: r.spans for r in pii.digests(documents(spark, rows)).collect()}
    for i, text in rows:
        assert ("secret:" in got[i]) == (i % 5 == 0), text
        assert ("ssn:" in got[i]) == (i % 7 == 0), text
    span = re.search(r"secret:(\d+):(\d+)", got[0])
    assert re.fullmatch("[0-9a-f]{40}", rows[0][1][int(span[1]) : int(span[2])])


def test_expectation_maximisation_finds_the_reliable_labelers():
    rng = random.Random(1)
    skill = [0.95, 0.9, 0.85, 0.5, 0.5, 0.7]
    patterns = {}
    truth = []
    for _ in range(4000):
        true = rng.random() < 0.4
        votes = tuple((1 if true else -1) * (1 if rng.random() < s else -1) for s in skill)
        patterns[votes] = patterns.get(votes, 0) + 1
        truth.append((votes, true))
    fit = pii.fit_reliabilities(patterns)
    right = sum((fit.chance(v) > 0.5) == t for v, t in truth) / len(truth)
    assert right > 0.95 and fit.prior == pytest.approx(0.4, abs=0.06)
    assert fit.true[0][2] > 0.9 and abs(fit.true[3][2] - 0.5) < 0.1


def test_awkward_rows(spark):
    frame = awkward(spark)
    got = pii.digests(frame).collect()
    assert len(got) == frame.count()
    assert {r.spans for r in got if r.doc_id in (1, 2, 3)} == {""}
    assert pii.digests(frame.limit(0)).count() == 0


@pytest.mark.parametrize("n", [40, 300, 5_000])
def test_long_secrets_are_one_span(spark, n):
    rng = random.Random(n)
    secret = "eyJ0" + "".join(rng.choices("abcdefABCDEF0123456789_+/=-", k=n - 5)) + "9"
    found = pii.search(documents(spark, [(1, f"the token {secret} ends here")])).first().candidates
    assert [(c.start, c.end) for c in found if c.kind == "secret"] == [(10, 10 + n)]
    lengths = [f for c in found for f in c.features if f.startswith("length:secret")]
    assert lengths == [f"length:secret:{n // 4 if n < 64 else 10 + n.bit_length() - 1}"]
