"""Language of a text by prediction by partial matching.

Every language has a tree of byte contexts up to four bytes long.  A byte costs
what the longest known context charges for it; a context that never saw the
byte charges its escape and passes on to the next shorter one (method C, without
exclusion, counts frozen after learning).  The language that codes the text in
the fewest bits wins.

The trees are tables: for every gram met in learning, of one to five bytes, the
code length of its last byte under each language, escapes included.  Scoring
looks grams up, and only those that no language met go on to shorter ones.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from revtide.llm.common import column_values, small_batches, utf8, with_columns

ORDER = 4
#: Documents of each language that are learned from, on average; picked by a hash of the id.
SAMPLE_PER_LANGUAGE = 400
SEED = 20240603
UNKNOWN = "und"
#: Before its first byte a text is taken to have line ends.
LEAD = b"\n" * ORDER
#: Bytes scored at once.
BLOCK = 1 << 18
_SPREAD = np.uint64(0x9E3779B97F4A7C15)


def held_out(doc_id: str = "doc_id") -> Column:
    """Whether the document is kept from learning; null ids are not."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def grams(data: np.ndarray, size: int) -> np.ndarray:
    """For each byte after the lead, it and the bytes before it as one number, oldest byte first."""
    n = len(data) - ORDER
    out = np.zeros(n, np.uint64)
    for k in range(size):
        out = (out << np.uint64(8)) | data[ORDER - size + 1 + k : ORDER - size + 1 + k + n]
    return out


def _count_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        by_language: dict[str, list[bytes]] = {}
        for lang, text in zip(column_values(batch, "lang"), column_values(batch, "text"), strict=True):
            by_language.setdefault(lang, []).append(text or b"")
        for lang, texts in by_language.items():
            for size in range(1, ORDER + 2):
                parts = [grams(np.frombuffer(LEAD + t, np.uint8).astype(np.uint64), size) for t in texts]
                key, n = np.unique(np.concatenate(parts), return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(key), pa.string()), pa.array(np.full(len(key), size)), pa.array(key.view(np.int64)), pa.array(n)],
                    names=["lang", "size", "gram", "n"],
                )


class Lookup:
    """Places of 64-bit keys, by one probe of a hash table and a search for the few that collide."""

    def __init__(self, keys: np.ndarray) -> None:
        self.keys = np.append(keys, np.uint64(2**64 - 1))  # no gram has eight bytes
        bits = max(8, int(len(keys) * 4).bit_length())
        self.shift = np.uint64(64 - bits)
        self.table = np.full(1 << bits, len(keys), np.int32)
        slots = ((keys * _SPREAD) >> self.shift).astype(np.int64)
        self.table[slots[::-1]] = np.arange(len(keys), dtype=np.int32)[::-1]
        lost = np.flatnonzero(self.table[slots] != np.arange(len(keys)))
        self.lost, self.lost_keys = lost, keys[lost]  # ascending, as the keys are

    def find(self, wanted: np.ndarray) -> np.ndarray:
        """Place of each key, -1 where there is none."""
        place = self.table[((wanted * _SPREAD) >> self.shift).astype(np.int64)].astype(np.int64)
        other = np.flatnonzero(self.keys[place] != wanted)
        place[other] = -1
        if len(self.lost_keys) and len(other):
            at = np.searchsorted(self.lost_keys, wanted[other]).clip(max=len(self.lost_keys) - 1)
            same = self.lost_keys[at] == wanted[other]
            place[other[same]] = self.lost[at[same]]
        return place


@dataclass
class Trees:
    """Code lengths in bits, by gram size from 1 and language."""

    languages: list[str]
    keys: list[np.ndarray]
    costs: list[np.ndarray]
    contexts: list[np.ndarray]
    escapes: list[np.ndarray]
    lookups: dict = field(default_factory=dict)

    def __getstate__(self):
        return self.__dict__ | {"lookups": {}}

    def _place(self, kind: str, level: int, wanted: np.ndarray) -> np.ndarray:
        if (kind, level) not in self.lookups:
            self.lookups[kind, level] = Lookup(getattr(self, kind)[level])
        return self.lookups[kind, level].find(wanted)

    def bits(self, wanted: np.ndarray, level: int = ORDER) -> np.ndarray:
        """Code length of each gram's last byte under each language."""
        if level < 0:
            return np.full((len(wanted), len(self.languages)), 8.0, np.float32)
        place = self._place("keys", level, wanted)
        out = self.costs[level][place]
        new = np.flatnonzero(place < 0)
        if len(new):
            below = self.bits(wanted[new] & np.uint64((1 << 8 * level) - 1), level - 1)
            context = self._place("contexts", level, wanted[new] >> np.uint64(8))
            below += np.where(context[:, None] < 0, np.float32(0), self.escapes[level][context])
            out[new] = below
        return out


def grow_trees(languages: list[str], counts: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> Trees:
    """From ``(language number, gram, count)`` arrays per gram size, 1 first."""
    trees = Trees(languages, [], [], [], [])
    for level, (lang, gram, n) in enumerate(counts):
        keys, row = np.unique(gram, return_inverse=True)
        table = np.zeros((len(keys), len(languages)))
        table[row, lang] = n
        contexts, parent = np.unique(keys >> np.uint64(8), return_inverse=True)
        total = np.zeros((len(contexts), len(languages)))
        kinds = np.zeros_like(total)
        np.add.at(total, parent, table)
        np.add.at(kinds, parent, table > 0)
        with np.errstate(divide="ignore", invalid="ignore"):
            escape = np.where(total > 0, np.log2((total + kinds) / kinds), 0.0)
            own = np.log2((total + kinds)[parent] / table)
        below = trees.bits(keys & np.uint64((1 << 8 * level) - 1), level - 1)
        costs = np.where(table > 0, own, escape[parent] + below)
        trees.keys.append(keys)
        trees.costs.append(np.vstack([costs, np.zeros((1, len(languages)))]).astype(np.float32))
        trees.contexts.append(contexts)
        trees.escapes.append(np.vstack([escape, np.zeros((1, len(languages)))]).astype(np.float32))
    return trees


def learn(documents: DataFrame, sample: int = SAMPLE_PER_LANGUAGE) -> Trees:
    """Trees from the labelled documents that are not held out.

    About ``sample`` whole texts of each language are taken, by a hash of their
    ids; their gram counts are summed in Spark and bounded by the sample.
    """
    small_batches(documents.sparkSession)
    labelled = documents.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("lang").cast("string").alias("lang"), utf8("text").alias("text")
    ).filter(F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & ~held_out())
    # One row per language reaches the driver, and goes back as a constant: no text is shuffled.
    sizes = labelled.groupBy("lang").agg(F.count(F.lit(1)).alias("rows")).collect()
    shares = [F.lit(value) for row in sizes for value in (row["lang"], sample / row["rows"])]
    draw = F.shiftrightunsigned(F.xxhash64(F.lit(SEED), "doc_id"), 11) / F.lit(float(1 << 53))
    drawn = labelled.filter(draw < F.element_at(F.create_map(*shares), F.col("lang")) if shares else F.lit(False))
    counted = drawn.select("lang", "text").mapInArrow(_count_batches, "lang string, size long, gram long, n long")
    table = counted.groupBy("lang", "size", "gram").agg(F.sum("n").alias("n")).toPandas()
    languages = sorted(table.lang.unique())
    number = {lang: k for k, lang in enumerate(languages)}
    counts = []
    for size in range(1, ORDER + 2):
        own = table[table["size"] == size]
        lang = own.lang.map(number).to_numpy(np.int64)
        counts.append((lang, own.gram.to_numpy(np.int64).view(np.uint64), own.n.to_numpy(np.float64)))
    return grow_trees(languages, counts)


def code_lengths(trees: Trees, texts: list[bytes]) -> np.ndarray:
    """Bits of each text under each language."""
    out = np.zeros((len(texts), len(trees.languages)))
    parts: list[bytes] = []
    owners: list[int] = []
    held = 0

    def flush() -> None:
        nonlocal held
        wanted = [grams(np.frombuffer(p, np.uint8).astype(np.uint64), ORDER + 1) for p in parts]
        starts = np.cumsum([0, *map(len, wanted[:-1])])
        np.add.at(out, owners, np.add.reduceat(trees.bits(np.concatenate(wanted)), starts, axis=0, dtype=np.float64))
        parts.clear()
        owners.clear()
        held = 0

    for k, text in enumerate(texts):
        for start in range(0, len(text), BLOCK):
            before = text[start - ORDER : start] if start else LEAD
            parts.append(before + text[start : start + BLOCK])
            owners.append(k)
            held += len(parts[-1])
            if held >= BLOCK:
                flush()
    if parts:
        flush()
    return out


def _score_batches(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees = shared.value
        for batch in batches:
            texts = [t or b"" for t in column_values(batch, "text")]
            known = [bool(trees.languages) and any(map(str.isalpha, t.decode("utf-8", "replace"))) for t in texts]
            best, score = [UNKNOWN] * len(texts), np.zeros(len(texts))
            at = np.flatnonzero(known)
            if len(at):
                bits = code_lengths(trees, [texts[k] for k in at])
                lead = bits - bits.min(axis=1, keepdims=True)
                score[at] = 1 / np.exp2(-lead).sum(axis=1)
                for k, lang in zip(at, bits.argmin(axis=1), strict=True):
                    best[k] = trees.languages[lang]
            new = {"lang_pred": pa.array(best, pa.string()), "score": pa.array(score)}
            yield with_columns(batch, ["doc_id", "held_out"], new)

    return run


def predict(documents: DataFrame, trees: Trees) -> DataFrame:
    """``doc_id, held_out, lang_pred, score`` for every row, from the text alone.

    ``score`` is the winner's share of the probability.  Null texts and texts
    without a letter, and all texts where nothing was learned, are ``und`` with
    score 0.  Equal code lengths go to the first language in order of names.
    Repeated rows and null ids each get their row, an empty table none.
    """
    spark = documents.sparkSession
    small_batches(spark)
    shared = spark.sparkContext.broadcast(trees)
    rows = documents.select(
        F.col("doc_id").cast("long").alias("doc_id"), held_out().alias("held_out"), utf8("text").alias("text")
    )
    return rows.mapInArrow(_score_batches(shared), "doc_id long, held_out boolean, lang_pred string, score double")
