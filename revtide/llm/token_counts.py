"""Token counts by a byte-level tokenizer, huge documents in overlapping chunks.

The tokenizer first cuts the text, from left to right, and then merges within
each cut piece.  From a cut on, the following cuts depend on nothing before it.
So where the cuts of two overlapping chunks meet, the tokens of the left chunk
before that point and of the right chunk after it are those of the whole text.
If no cuts meet in the overlap, the overlap is widened; at the latest it
reaches back to the last point where chunks met.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from revtide.llm.common import column_values, small_batches, utf8, with_columns
from revtide.llm.piece_memory import PieceMemory

LIMIT = 1024
#: Longer texts (code points) are huge.
HUGE = 32_768
CHUNK = 16_384
OVERLAP = 128
#: Cuts this close to the end of a chunk may come from its end: more than the
#: longest special token, and than the one character the cutting looks ahead.
UNSURE = 32

# White space as the tokenizer's pattern has it.  It always cuts before white
# space that follows something else, so these pieces end at cuts.
_PIECE = re.compile(r"[^\S\x1c-\x1f]*[\S\x1c-\x1f]+|[^\S\x1c-\x1f]+")


def piece_lengths(tokenizer: Tokenizer, **options) -> PieceMemory:
    """Numbers of tokens; a word's first token has its space, written as a G with a dot."""
    return PieceMemory(
        tokenizer, lambda ids, cuts: np.diff(cuts).tolist(), lambda token: token[0] == "\u0120", leads=True, **options
    )


@cache
def _memory(path: str) -> PieceMemory:
    """A worker's memory, which its later tasks find again."""
    return piece_lengths(Tokenizer.from_file(path))


def chunk_cuts(tokenizer: Tokenizer, text: str, start: int, end: int) -> tuple[np.ndarray, np.ndarray]:
    """Cuts of ``text[start:end]`` as positions in the text, and the chunk's tokens before each."""
    encoded = tokenizer.encode(text[start:end], add_special_tokens=False)
    if not encoded.ids:
        return np.array([start, end]), np.array([0, 0])
    ends = np.array([e for _, e in encoded.offsets], np.int64) + start
    words = np.array([-1 - k if w is None else w for k, w in enumerate(encoded.word_ids)], np.int64)
    last = np.flatnonzero(np.append(words[1:] != words[:-1], True))
    return np.concatenate(([start], ends[last])), np.concatenate(([0], last + 1))


def count_in_chunks(
    tokenizer: Tokenizer,
    text: str,
    chunk: int = CHUNK,
    overlap: int = OVERLAP,
    cuts: Callable = chunk_cuts,
) -> int:
    """Tokens of the whole text, from chunks spliced where their cuts meet."""
    n = len(text)
    if not n:
        return 0
    total, sure, sure_tokens = 0, 0, 0  # the text before ``sure`` is counted; the left chunk has so many tokens there
    left_end = min(chunk, n)
    places, tokens = cuts(tokenizer, text, 0, left_end)
    while left_end < n:
        width = overlap
        while True:
            start = max(left_end - width, sure)
            end = min(left_end + chunk, n)
            next_places, next_tokens = cuts(tokenizer, text, start, end)
            if start == sure:  # a proven cut: the right chunk alone is true from here on
                at = sure
                break
            met = np.intersect1d(places, next_places[1:])
            met = met[(met > start) & (met <= left_end - UNSURE)]
            if len(met):
                at = int(met[0])
                break
            width *= 2
        here = int(tokens[np.searchsorted(places, at)])
        total += here - sure_tokens
        sure, sure_tokens = at, int(next_tokens[np.searchsorted(next_places, at)])
        places, tokens, left_end = next_places, next_tokens, end
    return total + int(tokens[-1]) - sure_tokens


class Counter:
    """Counts tokens of texts; remembers the pieces of ordinary ones."""

    def __init__(self, path: str, huge: int = HUGE, chunk: int = CHUNK, overlap: int = OVERLAP) -> None:
        self.memory = _memory(path)
        self.tokenizer = self.memory.tokenizer
        self.huge, self.chunk, self.overlap = huge, chunk, overlap

    def counts(self, texts: list[str]) -> list[int]:
        """Tokens of each text."""
        ordinary = (_PIECE.findall(text) for text in texts if len(text) <= self.huge)
        known = map(sum, self.memory.of_documents(ordinary))
        return [
            next(known) if len(text) <= self.huge else count_in_chunks(self.tokenizer, text, self.chunk, self.overlap)
            for text in texts
        ]


def _count_batches(path: str, options: dict):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(path, **options)
        for batch in batches:
            texts = [t or b"" for t in column_values(batch, "text")]
            new = {
                "n_bytes": pa.array(list(map(len, texts)), pa.int64()),
                "n_tokens": pa.array(counter.counts([t.decode("utf-8", "replace") for t in texts]), pa.int64()),
            }
            yield with_columns(batch, ["doc_id"], new)

    return run


def token_counts(documents: DataFrame, tokenizer_path: str, limit: int = LIMIT, **options) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` for every row.

    Null and empty texts have no bytes and no tokens.  Special tokens' strings
    in a text count as the library has them, one token each.  Repeated rows and
    null ids each get their row, an empty table none.
    """
    small_batches(documents.sparkSession)
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), utf8("text").alias("text"))
    counted = rows.mapInArrow(_count_batches(tokenizer_path, options), "doc_id long, n_bytes long, n_tokens long")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
