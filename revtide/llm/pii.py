"""Personal data in texts, with DataFrame expressions only.

Four base kinds have exact patterns.  For other forms the patterns are loose
and weak supervision decides: regex, gazetteer and context labelers vote on each
candidate span, expectation-maximisation over the vote patterns estimates how
reliable each labeler is, and the resulting soft labels train a classifier on
the spans' own features, which has the last word.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from revtide.llm.common import stored

BASE = ("email", "ip", "card", "phone")
MORE = ("secret", "iban", "ssn", "person")
KINDS = BASE + MORE

# The base kinds' patterns.  A match can only begin where a run of
# its first class begins or where the last match ended, which spares long runs
# a fresh start at every place; possessive loops need no stack.
_AT_RUN = r"(?:\G|(?<!{0}))"
PATTERNS = {
    "email": r"(?=[A-Za-z0-9._%+-])" + _AT_RUN.format("[A-Za-z0-9._%+-]")
    + r"[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?=[0-9])" + _AT_RUN.format("[0-9]") + r"[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9]++(?:[\x20-][0-9]++)*+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    # Candidates; the candidate is the whole match.
    "secret": r"(?<![A-Za-z0-9_])[A-Za-z0-9_+/=-]{20,}+",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}+(?:\x20?[A-Z0-9]{1,3}+)?(?![A-Za-z0-9])",
    "ssn": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
    "person": r"(?<![\p{L}\p{N}])\p{Lu}\p{Ll}{1,20}+\x20\p{Lu}\p{Ll}{1,20}+(?![\p{L}\p{N}])",
}
# What a text must have for a kind to be worth a search.
HINTS = {
    "email": r"@", "ip": r"[0-9]\.[0-9]", "card": r"[0-9]", "phone": r"\+[0-9]", "secret": r"[A-Za-z0-9_+/=-]{20}",
    "iban": r"[A-Z]{2}[0-9]{2}", "ssn": r"[0-9]-[0-9]{2}-[0-9]", "person": r"\p{Ll}\x20\p{Lu}\p{Ll}",
}

# Words that the labelers know.
CONTEXT = {
    "secret": "token secret key apikey password passwd pwd credential bearer auth",
    "iban": "iban account bank konto cuenta compte bic swift",
    "ssn": "ssn social security insurance sozialversicherung",
    "person": "mr mrs ms dr prof name contact author regards herr frau monsieur madame senor senora sincerely dear",
}
HARMLESS = "version isbn issn sha commit checksum digest invoice order license build chapter figure table"
FIRST_NAMES = (
    "james mary john patricia robert jennifer michael linda david elizabeth william barbara richard susan joseph jessica "
    "thomas sarah charles karen anna peter paul maria hans klaus ursula jean pierre marie jose juan carmen luis ana"
)
LABELERS = ("format", "gazetteer", "near", "harmless", "variety", "edges")
_BEFORE = 32
_BUCKETS = 64


def _located(text: str, kind: str) -> tuple[Column, Column]:
    """The matches of a kind, and the text around them."""
    search = F.col(text).rlike(HINTS[kind])
    pattern = PATTERNS[kind]
    none = F.array().cast("array<string>")
    found = F.when(search, F.regexp_extract_all(F.col(text), F.lit(pattern), F.lit(0))).otherwise(none)
    around = F.when(search, F.split(F.col(text), pattern, -1)).otherwise(none)
    return found, around


def _spans(found: str, around: str) -> Column:
    """``start, end, value`` of the matches: a match starts after all that came before it."""
    step = (
        f"named_struct('at', a.at + length(get({around}, i)) + length(get({found}, i)), 'starts', "
        f"concat(a.starts, array(a.at + length(get({around}, i)))))"
    )
    return F.expr(
        f"if(size({found}) = 0, array(), zip_with(aggregate(sequence(0, size({found}) - 1), "
        f"named_struct('at', 0, 'starts', cast(array() AS array<int>)), (a, i) -> {step}).starts, {found}, "
        "(s, v) -> named_struct('start', s, 'end', s + length(v), 'value', v)))"
    ).cast("array<struct<start: int, end: int, value: string>>")


_DIGITS = "regexp_replace(x.value, '[^0-9]', '')"
_LUHN = (
    f"aggregate(sequence(1, length({_DIGITS})), 0, (s, i) -> s + "
    f"cast(substring(reverse({_DIGITS}), i, 1) AS INT) * (2 - i % 2) - "
    f"if(i % 2 = 0 AND substring(reverse({_DIGITS}), i, 1) > '4', 9, 0)) % 10 = 0"
)
VALID = {
    "email": "true",
    "ip": "forall(split(x.value, '[.]'), p -> length(ltrim('0', p)) < 4 AND "
    "coalesce(try_cast(ltrim('0', p) AS INT), 0) <= 255)",
    "card": f"length({_DIGITS}) BETWEEN 14 AND 19 AND {_LUHN}",
    "phone": f"length({_DIGITS}) BETWEEN 10 AND 15",
}


def _words(words: str) -> str:
    return rf"(?i)(?<![\\p{{L}}])({'|'.join(words.split())})(?![\\p{{L}}])"


def _vote(yes: str, no: str = "false") -> str:
    return f"CASE WHEN {yes} THEN 1 WHEN {no} THEN -1 ELSE 0 END"


_MIXED = "x.value RLIKE '[0-9]' AND x.value RLIKE '[A-Za-z]'"
FORMAT = {
    "secret": _vote(f"{_MIXED} AND x.value RLIKE '^(?:[0-9a-f]{{32,}}|[0-9A-F]{{32,}}|[A-Za-z0-9_+/=-]{{24,}})$'", f"NOT ({_MIXED})"),
    "iban": _vote("length(replace(x.value, ' ', '')) BETWEEN 15 AND 34 AND x.value RLIKE '[0-9]{4}'"),
    "ssn": _vote("NOT x.value RLIKE '^(?:000|666|9)|-00-|-0000$'", "x.value RLIKE '^(?:000|666|9)|-00-|-0000$'"),
    "person": _vote("false", "x.value RLIKE '^(?:The|And|This|That|With|From|Die|Der|Das|Les|Des|Los|Las|Une|Una) '"),
}
GAZETTEER = {
    "secret": _vote("x.value RLIKE '^(?:AKIA|ghp_|gho_|sk-|sk_|xox|eyJ)'"),
    "iban": _vote("substring(x.value, 1, 2) IN ('DE','FR','ES','IT','GB','NL','BE','AT','CH','PT','PL','IE','SE','DK')"),
    "ssn": "0",
    "person": _vote(f"lower(x.value) RLIKE '^(?:{'|'.join(FIRST_NAMES.split())}) '"),
}


def _candidates(kind: str, spans: str, text: str) -> Column:
    """Candidates of a kind with the labelers' votes and the classifier's features."""
    before = f"lower(substring({text}, greatest(x.start - {_BEFORE}, 0) + 1, least(x.start, {_BEFORE})))"
    left = f"substring({text}, x.start, 1)"
    right = f"substring({text}, x.end + 1, 1)"
    near = _vote(f"{before} RLIKE '{_words(CONTEXT[kind])}'")
    harmless = _vote("false", f"{before} RLIKE '{_words(HARMLESS)}'")
    kinds_of_chars = "size(array_distinct(split(lower(x.value), '')))"
    variety = {"person": "0"}.get(kind, _vote(f"{kinds_of_chars} >= 6", f"{kinds_of_chars} <= 3"))
    edges = _vote(
        f"x.start = 0 OR {left} RLIKE '[\\\\s\"(\\'=:]'",
        f"x.start > 0 AND {left} RLIKE '[\\\\p{{L}}\\\\p{{N}}]' OR {right} RLIKE '[\\\\p{{L}}\\\\p{{N}}@]'",
    )
    votes = ", ".join(f"tinyint({v})" for v in (FORMAT[kind], GAZETTEER[kind], near, harmless, variety, edges))
    last_word = f"regexp_extract({before}, '([\\\\p{{L}}]+)[^\\\\p{{L}}]*$', 1)"
    shape = (
        "substring(regexp_replace(regexp_replace(regexp_replace(x.value, '[A-Z]+', 'A'), '[a-z]+', 'a'), '[0-9]+', '9'), 1, 8)"
    )
    features = ", ".join(
        f"concat('{name}:{kind}:', {value})"
        for name, value in (
            ("length", "CASE WHEN x.end - x.start < 64 THEN (x.end - x.start) DIV 4 ELSE 10 + floor(log2(x.end - x.start)) END"),
            ("shape", f"pmod(xxhash64({shape}), {_BUCKETS})"),
            ("word", f"pmod(xxhash64({last_word}), {_BUCKETS})"),
            ("left", f"CASE WHEN x.start = 0 THEN 'none' WHEN {left} RLIKE '\\\\s' THEN 'space' WHEN {left} RLIKE '[\"=:\\']' THEN 'mark' ELSE 'other' END"),
            ("right", f"CASE WHEN {right} = '' THEN 'none' WHEN {right} RLIKE '\\\\s' THEN 'space' WHEN {right} RLIKE '[.,;]' THEN 'stop' ELSE 'other' END"),
        )
    )
    return F.expr(
        f"transform({spans}, x -> named_struct('start', x.start, 'end', x.end, 'kind', '{kind}', "
        f"'votes', array({votes}), 'features', array({features})))"
    )


def search(documents: DataFrame) -> DataFrame:
    """``doc_id, base, candidates`` of every row; spans count code points, the end excluded."""
    rows = documents.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")
    )
    found = {}
    for kind in KINDS:
        found[f"{kind}_found"], found[f"{kind}_around"] = _located("text", kind)
    rows = rows.withColumns(found)
    rows = rows.withColumns({kind: _spans(f"{kind}_found", f"{kind}_around") for kind in KINDS})
    base = F.concat(
        *[
            F.expr(
                f"transform(filter({kind}, x -> {VALID[kind]}), "
                f"x -> named_struct('start', x.start, 'rank', {rank}, 'end', x.end))"
            )
            for rank, kind in enumerate(BASE)
        ]
    )
    candidates = F.concat(*[_candidates(kind, kind, "text") for kind in MORE])
    return rows.select("doc_id", F.array_sort(base).alias("base"), candidates.alias("candidates")).withColumn(
        "candidates",
        F.expr("filter(candidates, c -> NOT exists(base, b -> b.start < c.end AND c.start < b.end))"),
    )


# Reliabilities

@dataclass(frozen=True)
class Reliabilities:
    """Share of true spans, and each labeler's chances of voting -1, 0 and 1 on true and on other spans."""

    prior: float
    true: list[list[float]]
    other: list[list[float]]

    def chance(self, votes: Sequence[int]) -> float:
        """Probability that a span with these votes is personal data."""
        odds = math.log(self.prior) - math.log1p(-self.prior)
        for k, vote in enumerate(votes):
            odds += math.log(self.true[k][vote + 1]) - math.log(self.other[k][vote + 1])
        return 1 / (1 + math.exp(-max(min(odds, 500.0), -500.0)))


def fit_reliabilities(patterns: dict[tuple[int, ...], int], rounds: int = 50) -> Reliabilities:
    """Expectation-maximisation over vote patterns and their numbers, from the majority vote on."""
    labelers = len(LABELERS)
    chance = {votes: 1 / (1 + math.exp(-2.0 * sum(votes) + 3.0)) for votes in patterns}
    fit = Reliabilities(0.5, [[1 / 3] * 3] * labelers, [[1 / 3] * 3] * labelers)
    for _ in range(rounds):
        yes = sum(n * chance[v] for v, n in patterns.items())
        no = sum(n * (1 - chance[v]) for v, n in patterns.items())

        def rates(weight: Callable[[tuple[int, ...]], float], total: float) -> list[list[float]]:
            return [
                [
                    (1 + sum(n * weight(v) for v, n in patterns.items() if v[k] == vote)) / (3 + total)
                    for vote in (-1, 0, 1)
                ]
                for k in range(labelers)
            ]

        fit = Reliabilities((1 + yes) / (2 + yes + no), rates(lambda v: chance[v], yes), rates(lambda v: 1 - chance[v], no))
        chance = {votes: fit.chance(votes) for votes in patterns}
    return fit


def _lookup(values: dict[str, float], key: str) -> str:
    """A fixed map of names to numbers, 0 for names it lacks."""
    if not values:
        return "0D"
    entries = ", ".join(f"'{name}', {value!r}D" for name, value in sorted(values.items()))
    return f"coalesce(element_at(map({entries}), {key}), 0D)"


def train_classifier(candidates: DataFrame) -> tuple[float, dict[str, float]]:
    """Log odds of a span and of its features, from ``votes, features`` rows.

    Spark counts the vote patterns (3^6 at most) and, weighted with the chances
    that follow from them, the features (some 800 names at most); the driver
    sees these counts only.
    """
    counts = candidates.groupBy("votes").agg(F.count(F.lit(1)).alias("n")).collect()
    patterns = {tuple(row["votes"]): row["n"] for row in counts}
    if not patterns:
        return -1.0, {}
    fit = fit_reliabilities(patterns)
    named = {"".join("-0+"[v + 1] for v in votes): fit.chance(votes) for votes in patterns}
    name = "array_join(transform(votes, v -> CASE v WHEN 1 THEN '+' WHEN 0 THEN '0' ELSE '-' END), '')"
    chance = F.expr(_lookup(named, name))
    soft = candidates.select(chance.alias("yes"), F.explode("features").alias("feature"))
    sums = soft.groupBy("feature").agg(F.sum("yes").alias("yes"), F.sum(1 - F.col("yes")).alias("no")).collect()
    yes = sum(n * fit.chance(v) for v, n in patterns.items())
    no = sum(n for n in patterns.values()) - yes
    weights = {
        row["feature"]: math.log((row["yes"] + 0.5) / (yes + 1)) - math.log((row["no"] + 0.5) / (no + 1)) for row in sums
    }
    return math.log((yes + 0.5) / (no + 0.5)), weights


def personal_data(documents: DataFrame) -> DataFrame:
    """``doc_id, base, added`` of every row, spans as ``start, rank, end`` with the kind's rank in KINDS.

    ``base`` has the valid matches of the four base patterns, ``added`` the
    candidates that the classifier takes; these never overlap a base span.  A
    null text is empty.  Repeated rows and null ids each get their row, an empty
    table none.
    """
    found = stored(search(documents), "spans")
    prior, weights = train_classifier(found.select(F.explode("candidates").alias("c")).select("c.votes", "c.features"))
    ranks = " ".join(f"WHEN '{kind}' THEN {rank}" for rank, kind in enumerate(KINDS))
    scored = f"aggregate(c.features, {prior!r}D, (s, f) -> s + {_lookup(weights, 'f')}) > 0D"
    added = F.expr(
        f"transform(filter(candidates, c -> {scored}), "
        f"c -> named_struct('start', c.start, 'rank', CASE c.kind {ranks} END, 'end', c.end))"
    )
    return found.select("doc_id", "base", F.array_sort(added).alias("added"))


def span_text(spans: str) -> Column:
    """``kind:start:end`` of sorted spans, joined by commas."""
    kinds = ", ".join(f"'{kind}'" for kind in KINDS)
    return F.expr(f"array_join(transform({spans}, s -> concat(array({kinds})[s.rank], ':', s.start, ':', s.end)), ',')")


def digests(documents: DataFrame) -> DataFrame:
    """Counts of the base kinds, checksum of the base spans and text of all spans per row."""
    found = personal_data(documents)
    counts = [F.expr(f"cast(size(filter(base, s -> s.rank = {k})) AS BIGINT)").alias(f"n_{kind}") for k, kind in enumerate(BASE)]
    return found.withColumn("every", F.array_sort(F.concat("base", "added"))).select(
        "doc_id", *counts, F.sha2(span_text("base"), 256).alias("base_sha256"), span_text("every").alias("spans")
    )
