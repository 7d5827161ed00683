"""Phrases whose words stick together, mined per language by partitions of the corpus (SON).

Shards are runs of documents that one task holds.  A phrase with ``support``
occurrences in a language has, in at least one shard, its proportional part of
them, so every shard is mined completely, level by level, at the support lowered
to its share of the language's words.  What is frequent somewhere is united, and
an upper bound, the counts reported and for each silent shard what it can have
kept to itself, drops most that cannot reach the support.  The rest goes into a
filter of fixed size, and a second pass counts all phrases that pass it in all
documents.  Counts of at least the support are then whole and exact.

In both passes a task adds up its shards before anything leaves it, and there are
as many tasks as the cluster keeps busy, not as many as the corpus has shards.  So
a phrase leaves in a few rows however large the corpus is.  Of the first pass a
task reports what reaches the task's own share of the support.

Where shards are so many that a lowered support is one, every shard reports all
its phrases with their counts, and the bound is the count itself.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from revtide.llm.common import column_values, small_batches, stored, utf8

SUPPORT = 100
MOST_WORDS = 5
TOP = 2000
#: Words of a shard, at least and at most: a task mines what it has once twice as many
#: are there, or no more come.  In between a shard is a fiftieth of the corpus.
SHARD_WORDS = (1 << 21, 1 << 22)
SHARDS = 50
#: Phrases that a task adds up over its shards; with more it hands them on and begins anew.
HELD_PHRASES = 1 << 21
#: Tasks for each core of the cluster.
TASKS_PER_CORE = 2
#: Bits of the filter of candidates, a power of two.
FILTER_BITS = 1 << 25
UNKNOWN = "und"

_BREAKS = b".,;:!?\n\x0b\x0c\r"
_TABLE = bytes.maketrans(_BREAKS + b"\t", b"." * len(_BREAKS) + b" ")
_MIX = np.uint64(0x9E3779B97F4A7C15)


def tokens(texts: list[bytes | None]) -> tuple[np.ndarray, pa.Array]:
    """Word numbers of the texts one after the other, -1 between pieces, and the words."""
    spaced = [(t or b"").lower().translate(_TABLE).replace(b".", b" . ") + b" ." for t in texts]
    try:
        strings = pa.array(spaced, pa.binary()).cast(pa.string())
    except pa.ArrowInvalid:  # not UTF-8
        strings = pa.array([t.decode("utf-8", "replace") for t in spaced], pa.string())
    words = pc.ascii_split_whitespace(strings)
    coded = words.flatten().dictionary_encode()
    ids, known = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), coded.dictionary
    empty, stop = known.index("").as_py(), known.index(".").as_py()
    if empty >= 0:
        ids = ids[ids != empty]
    ids[ids == stop] = -1
    return ids, known


def word_count(text: bytes | None) -> int:
    return len((text or b"").translate(_TABLE).replace(b".", b" ").split())


def _mixed(x: np.ndarray) -> np.ndarray:
    x = x * _MIX
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(29))


def word_hashes(lang: str, words: pa.Array) -> np.ndarray:
    seed = xxhash.xxh64_intdigest(lang.encode())
    digest = xxhash.xxh64_intdigest
    return np.fromiter((digest(w, seed) for w in words.cast(pa.binary()).to_pylist()), np.uint64, len(words))


def phrase_hashes(ids: np.ndarray, hashes: np.ndarray, at: np.ndarray, size: int) -> np.ndarray:
    out = np.full(len(at), size, np.uint64)
    for k in range(size):
        out = _mixed(out ^ hashes[ids[at + k]])
    return out


def levels(
    ids: np.ndarray, chosen: Callable[[np.ndarray, np.ndarray, int], np.ndarray], most: int = MOST_WORDS
) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For each length the chosen phrases: where each stands first, and how often.

    ``chosen`` gets places, counts and the length, and says which phrases stay.
    A phrase is only formed where both phrases of one word less have stayed.
    """
    code = ids
    for size in range(1, most + 1):
        if size == 1:
            at = np.flatnonzero(code >= 0)
            key = code[at]
        else:
            at = np.flatnonzero((code[:-1] >= 0) & (code[1:] >= 0))
            key = code[at] * (code.max(initial=0) + 1) + code[at + 1]
        if not len(at):
            return
        _, first, number, counts = np.unique(key, return_index=True, return_inverse=True, return_counts=True)
        stay = chosen(at[first], counts, size)
        code = np.full(len(ids), -1, np.int64)
        kept = stay[number]
        code[at[kept]] = (np.cumsum(stay) - 1)[number[kept]]
        if stay.any():
            yield size, at[first[stay]], counts[stay]


def local_support(words: int, of: int, support: int = SUPPORT) -> int:
    """The part of the support that falls to so many of the language's words, rounded up."""
    return max(1, -(-support * words // max(of, 1)))


def _shards(batches: Iterator[pa.RecordBatch], columns: list[str], shard_words: int) -> Iterator[dict[tuple, list]]:
    """Texts by the other columns, of so many words that a task can hold them."""
    held: list[tuple[tuple, bytes, int]] = []
    words = 0
    for batch in batches:
        for *group, text in zip(*(column_values(batch, c) for c in (*columns, "text")), strict=True):
            n = word_count(text)
            if n:
                held.append((tuple(group), text, n))
                words += n
        if words >= 2 * shard_words:
            cut = taken = 0
            while taken < shard_words:
                taken += held[cut][2]
                cut += 1
            yield _by_group(held[:cut])
            held, words = held[cut:], words - taken
    if held:
        yield _by_group(held)


def _by_group(held: list[tuple[tuple, bytes, int]]) -> dict[tuple, list]:
    out: dict[tuple, list] = {}
    for group, text, _ in held:
        out.setdefault(group, []).append(text)
    return out


class _Run:
    """What the shards of a run have reported of a language, phrases by their hashes."""

    def __init__(self):
        self.hashes = np.zeros(0, np.uint64)
        self.counts = self.reported = np.zeros(0, np.int64)
        self.silent = self.words = 0

    def add(self, hashes: np.ndarray, counts: np.ndarray, silent: int, words: int) -> None:
        """A shard of so many words; what it does not report occurs ``silent`` times there at most."""
        reported = np.concatenate([self.reported, np.full(len(hashes), silent)])
        counts = np.concatenate([self.counts, counts])
        self.hashes, place = np.unique(np.concatenate([self.hashes, hashes]), return_inverse=True)
        self.counts, self.reported = (
            np.bincount(place, x, len(self.hashes)).astype(np.int64) for x in (counts, reported)
        )
        self.silent += silent
        self.words += words

    def report(self, lang: str, of: int, support: int) -> Iterator[pa.RecordBatch]:
        """The phrases that may have the run's part of the support, at the most they may have.

        What the shards have kept to themselves adds up to less than that part.
        """
        least = local_support(self.words, of, support)
        most = self.counts + self.silent - self.reported
        stay = most >= least
        yield _mined(lang, pa.array(self.hashes[stay].view(np.int64)), pa.array(most[stay]), least - 1)
        yield _mined(lang, pa.nulls(1, pa.int64()), pa.array([0], pa.int64()), least - 1)


def _mine_batches(support: int, most: int, shard_words: int, held: int = HELD_PHRASES):
    """Frequent phrases of each task, or run of its shards, as ``lang, hash, n, silent``;
    ``n`` is the most that a phrase may have in the run, ``silent`` what one may have
    without being reported.  A row without a hash stands for the run itself."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        runs: dict[tuple[str, int], _Run] = {}
        for shard in _shards(batches, ["lang", "of"], shard_words):
            for (lang, of), texts in shard.items():
                ids, words = tokens(texts)
                size_of = int((ids >= 0).sum())
                least = local_support(size_of, of, support)
                own = word_hashes(lang, words)
                found, counts = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
                for size, at, n in levels(ids, lambda at, n, size, least=least: n >= least, most):
                    found.append(phrase_hashes(ids, own, at, size))
                    counts.append(n)
                hashes, place = np.unique(np.concatenate(found), return_inverse=True)
                sums = np.bincount(place, np.concatenate(counts), len(hashes)).astype(np.int64)
                runs.setdefault((lang, of), _Run()).add(hashes, sums, least - 1, size_of)
            if sum(len(r.hashes) for r in runs.values()) > held:
                for (lang, of), own_run in runs.items():
                    yield from own_run.report(lang, of, support)
                runs = {}
        for (lang, of), own_run in runs.items():
            yield from own_run.report(lang, of, support)

    return run


def _mined(lang: str, hashes: pa.Array, counts: pa.Array, silent: int) -> pa.RecordBatch:
    rows = len(hashes)
    return pa.RecordBatch.from_arrays(
        [pa.array([lang] * rows, pa.string()), hashes, counts, pa.array(np.full(rows, silent, np.int64))],
        names=["lang", "hash", "n", "silent"],
    )


def candidate_hashes(mined: DataFrame, support: int = SUPPORT) -> DataFrame:
    """``lang, hash`` of what may reach the support over all shards."""
    known = mined.filter("hash IS NOT NULL").groupBy("lang", "hash").agg(
        F.sum("n").alias("n"), F.sum("silent").alias("reported")
    )
    silent = mined.filter("hash IS NULL").groupBy("lang").agg(F.sum("silent").alias("silent"))
    most = F.col("n") + F.col("silent") - F.col("reported")
    return known.join(silent, "lang").filter(most >= support).select("lang", "hash")


def _places(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    mask = np.uint64(FILTER_BITS - 1)
    return (hashes & mask).astype(np.int64), ((hashes >> np.uint64(32)) & mask).astype(np.int64)


def candidate_filter(candidates: DataFrame) -> np.ndarray:
    """Two bits for each candidate, in ``FILTER_BITS`` bits whatever their number."""
    mask = F.lit(FILTER_BITS - 1).cast("long")
    places = F.array(F.col("hash").bitwiseAND(mask), F.shiftrightunsigned("hash", 32).bitwiseAND(mask))
    bits = candidates.select(F.explode(places).alias("place")).select(
        F.shiftright("place", 6).alias("word"),
        F.expr("shiftleft(1L, CAST(place & 63 AS INT))").alias("bit"),
    )
    packed = bits.groupBy("word").agg(F.bit_or("bit").alias("bits")).toPandas()  # FILTER_BITS / 64 rows at most
    out = np.zeros(FILTER_BITS // 64, np.int64)
    out[packed.word.to_numpy(np.int64)] = packed.bits.to_numpy(np.int64)
    return out


def _passing(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    good = np.ones(len(hashes), bool)
    for place in _places(hashes):
        good &= (bits[place >> 6] >> (place & 63)) & 1 == 1
    return good


def _summed(parts: list[pa.RecordBatch]) -> list[pa.RecordBatch]:
    """``lang, phrase, n``, every phrase once."""
    if len(parts) < 2:
        return parts
    sums = pa.Table.from_batches(parts).group_by(["lang", "phrase"], use_threads=False).aggregate([("n", "sum")])
    return sums.select(["lang", "phrase", "n_sum"]).rename_columns(["lang", "phrase", "n"]).combine_chunks().to_batches()


def _count_batches(shared, most: int, shard_words: int, held: int = HELD_PHRASES):
    """``lang, phrase, n``: the phrases of a task that pass the filter, and how often they
    occur in it.  A phrase comes again only where a task has more than ``held`` phrases."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = shared.value
        parts: list[pa.RecordBatch] = []
        summed = waiting = 0
        for shard in _shards(batches, ["lang"], shard_words):
            for (lang,), texts in shard.items():
                ids, words = tokens(texts)
                own = word_hashes(lang, words)

                def chosen(at, n, size, ids=ids, own=own):
                    return _passing(bits, phrase_hashes(ids, own, at, size))

                for size, at, n in levels(ids, chosen, most):
                    words_at = [words.take(pa.array(ids[at + k])) for k in range(size)]
                    phrase = pc.binary_join_element_wise(*words_at, " ") if size > 1 else words_at[0]
                    parts.append(
                        pa.RecordBatch.from_arrays(
                            [pa.array([lang] * len(at), pa.string()), phrase, pa.array(n.astype(np.int64))],
                            names=["lang", "phrase", "n"],
                        )
                    )
                    waiting += len(at)
            if waiting > min(max(summed, held // 4), held):
                parts = _summed(parts)
                summed, waiting = sum(p.num_rows for p in parts), 0
                if summed > held:
                    yield from parts
                    parts, summed = [], 0
        yield from _summed(parts)

    return run


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sums: dict[str, int] = {}
    for batch in batches:
        for lang, text in zip(column_values(batch, "lang"), column_values(batch, "text"), strict=True):
            sums[lang] = sums.get(lang, 0) + word_count(text)
    rows = [pa.array(list(sums), pa.string()), pa.array(list(sums.values()), pa.int64())]
    yield pa.RecordBatch.from_arrays(rows, names=["lang", "of"])


def phrase_counts(
    documents: DataFrame,
    support: int = SUPPORT,
    most_words: int = MOST_WORDS,
    shard_words: int | None = None,
    tasks: int | None = None,
) -> DataFrame:
    """``lang, phrase, f`` of every phrase of 1 to ``most_words`` words with at
    least ``support`` occurrences in its language, and ``n``, the language's words.

    Occurrences overlap and lie within pieces.  A null lang is ``und``; null and
    empty texts have no words.  Repeated rows count again.  ``tasks`` is how many
    tasks a pass has at most, by default two for each core that the session knows
    of; name it where executors come and go.
    """
    spark = documents.sparkSession
    tasks = tasks or TASKS_PER_CORE * spark.sparkContext.defaultParallelism
    small_batches(spark)
    rows = documents.select(F.coalesce(F.col("lang").cast("string"), F.lit(UNKNOWN)).alias("lang"), utf8("text").alias("text"))
    sizes = rows.mapInArrow(_count_words, "lang string, of long").groupBy("lang").agg(F.sum("of").alias("of"))
    sizes = stored(sizes, "words")
    if shard_words is None:
        words = sizes.agg(F.sum("of")).first()[0] or 0
        shard_words = min(max(words // SHARDS, SHARD_WORDS[0]), SHARD_WORDS[1])
    mined = stored(
        rows.join(sizes, "lang").select("lang", "of", "text").coalesce(tasks).mapInArrow(
            _mine_batches(support, most_words, shard_words), "lang string, hash long, n long, silent long"
        ),
        "mined",
    )
    candidates = candidate_hashes(mined, support)
    shared = spark.sparkContext.broadcast(candidate_filter(candidates))  # FILTER_BITS at any size
    counted = rows.coalesce(tasks).mapInArrow(
        _count_batches(shared, most_words, shard_words), "lang string, phrase string, n long"
    )
    frequent = counted.groupBy("lang", "phrase").agg(F.sum("n").alias("f")).filter(F.col("f") >= support)
    return stored(frequent.join(sizes.withColumnRenamed("of", "n"), "lang"), "phrases")


def _wide(column: str) -> Column:
    return F.col(column).cast("decimal(19,0)")


def scored(counts: DataFrame) -> DataFrame:
    """``lang, phrase, a, l, r, n, score``: each phrase at its lowest-scoring cut.

    All parts of a phrase are at least as frequent as itself, so they are in
    ``counts``.  Products are decimals of 38 digits.
    """
    words = F.split("phrase", " ")
    whole = counts.filter(F.instr("phrase", " ") > 0).select("lang", "phrase", F.col("f").alias("a"), "n", words.alias("words"))
    cut = whole.withColumn("k", F.explode(F.sequence(F.lit(1), F.size("words") - 1)))
    cut = cut.withColumn("left", F.array_join(F.slice("words", F.lit(1), F.col("k")), " ")).withColumn(
        "right", F.array_join(F.slice("words", F.col("k") + 1, F.size("words")), " ")
    )
    part = counts.select("lang", "phrase", "f")
    cut = cut.join(part.withColumnsRenamed({"phrase": "left", "f": "l"}), ["lang", "left"])
    cut = cut.join(part.withColumnsRenamed({"phrase": "right", "f": "r"}), ["lang", "right"])
    above = (_wide("a") * F.lit(1000).cast("decimal(4,0)")).cast("decimal(19,0)") * _wide("n")
    cut = cut.withColumn("above", above.cast("decimal(38,0)")).withColumn(
        "below", (_wide("l") * _wide("r")).cast("decimal(38,0)")
    )
    score = F.expr("above DIV below").alias("score")
    least = cut.groupBy("lang", "phrase", "a", "n").agg(F.min(F.struct(score, "k", "l", "r")).alias("cut"))
    return least.select("lang", "phrase", "a", "cut.l", "cut.r", "n", "cut.score")


def not_within_longer(scores: DataFrame) -> DataFrame:
    """The phrases that no longer one holds as often.

    Counts fall with length, so if any longer phrase holds one as often, one
    with a single word more does.
    """
    words = F.split("phrase", " ")
    longer = scores.select("lang", "a", words.alias("words")).filter(F.size("words") > 2)
    parts = longer.select(
        "lang",
        "a",
        F.explode(
            F.array(
                F.array_join(F.slice("words", F.lit(1), F.size("words") - 1), " "),
                F.array_join(F.slice("words", F.lit(2), F.size("words") - 1), " "),
            )
        ).alias("phrase"),
    )
    held = parts.groupBy("lang", "phrase").agg(F.max("a").alias("held"))
    return scores.join(held, ["lang", "phrase"], "left").filter("held IS NULL OR held < a").drop("held")


def collocations(documents: DataFrame, top: int = TOP, **options) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: each language's first phrases by
    score, then count, then the phrase's bytes.

    Nulls, empty texts and repeated rows as in ``phrase_counts``; an empty table
    gives no rows; other columns play no part.
    """
    kept = not_within_longer(stored(scored(phrase_counts(documents, **options)), "scores"))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = kept.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
