"""Token ids of texts, with words as columns: no Python object a word.

Texts are split at white space, which the tokenizer drops and never joins
across, and dictionary-encoded, so each distinct word of a group of texts is
looked up once.  A word of letters and the stops after it are two parts, which
the tokenizer cuts apart anyway; a worker remembers the ids of parts.  Ids of
texts are gathered from those of their words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from tokenizers import Tokenizer

#: Parts that a worker remembers, at most, and their bytes.
MOST_PARTS = 1_500_000
MOST_BYTES = 64 << 20
#: Words of letters that are encoded as one text.
JOINED = 512

#: Letters to every library, in their composed form.
_LETTERS = "^[A-Za-zªµºÀ-ÖØ-öø-ɏ]+$"
_STOPS = ".,;:!?"


def spans(first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The places of spans one after the other."""
    ends = np.cumsum(size)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(first - ends + size, size)


def words_of(texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Words of each text, their numbers one text after the other, and the distinct words."""
    filled = [t or b"" for t in texts]
    try:
        strings = pa.array(filled, pa.binary()).cast(pa.string())
    except pa.ArrowInvalid:  # not UTF-8
        strings = pa.array([t.decode("utf-8", "replace") for t in filled])
    split = pc.ascii_split_whitespace(strings)
    coded = split.flatten().dictionary_encode()
    return np.diff(split.offsets.to_numpy()), coded.indices.to_numpy(zero_copy_only=False), coded.dictionary


def parts_of(words: pa.Array) -> tuple[pa.Array, pa.Array]:
    """Each word's first part and the stops after it, if the first is of letters; else the word and nothing."""
    head = pc.utf8_rtrim(words, _STOPS)
    letters = pc.match_substring_regex(head, _LETTERS)
    tail = pc.replace_substring_regex(words, "^.*[^.,;:!?]", "")
    return pc.if_else(letters, pc.ascii_lower(head), words), pc.if_else(letters, tail, "")


class ColumnarEncoder:
    """Ids of texts by a tokenizer that lowers its text, marks words' ends and drops white space."""

    def __init__(self, tokenizer: Tokenizer, most_parts: int = MOST_PARTS, most_bytes: int = MOST_BYTES) -> None:
        self.tokenizer, self.most_parts, self.most_bytes = tokenizer, most_parts, most_bytes
        vocabulary = tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values(), default=0) + 1, bool)
        self.ends[[number for token, number in vocabulary.items() if token.endswith("</w>")]] = True
        self._forget()

    def _forget(self) -> None:
        self.known = pa.array([""], pa.string())
        self.ids, self.first, self.size = np.zeros(0, np.int32), np.zeros(1, np.int64), np.zeros(1, np.int64)

    def encode(self, texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray]:
        """All ids one text after the other, and how many each text has."""
        counts, numbers, words = words_of(texts)
        head, tail = parts_of(words)
        place = self._places(pa.concat_arrays([head, tail]))
        both = np.stack([place[: len(words)], place[len(words) :]], axis=1).reshape(-1)
        word_ids = self.ids[spans(self.first[both], self.size[both])]
        word_size = self.size[both].reshape(-1, 2).sum(axis=1)
        word_first = np.cumsum(word_size) - word_size
        ids = word_ids[spans(word_first[numbers], word_size[numbers])]
        so_far = np.concatenate(([0], np.cumsum(word_size[numbers])))
        ends = np.cumsum(counts)
        return ids, so_far[ends] - so_far[ends - counts]

    def _places(self, parts: pa.Array) -> np.ndarray:
        """The numbers of parts among the known ones; unknown ones are learnt."""
        if len(self.known) > self.most_parts or self.known.nbytes > self.most_bytes:
            self._forget()
        at = pc.index_in(parts, value_set=self.known)
        out = pc.fill_null(at, 0).to_numpy().copy()
        if at.null_count:
            missing = pc.is_null(at)
            before, asked = len(self.known), parts.filter(missing)
            new = self._learn(pc.unique(asked))
            out[missing.to_numpy(zero_copy_only=False)] = before + pc.index_in(asked, value_set=new).to_numpy()
        return out

    def _learn(self, new: pa.Array) -> pa.Array:
        """Adds parts to the known ones; returns them in the order they got."""
        letters = pc.match_substring_regex(new, _LETTERS)
        order, ids, sizes = [], [self.ids], [self.size]
        for some, encoded in ((letters, self._joined), (pc.invert(letters), self._one_by_one)):
            parts = new.filter(some)
            order.append(parts)
            for part_ids, part_sizes in encoded(parts.to_pylist()):
                ids.append(part_ids)
                sizes.append(part_sizes)
        self.known = pa.concat_arrays([self.known, *order])
        self.ids, self.size = np.concatenate(ids), np.concatenate(sizes)
        self.first = np.cumsum(self.size) - self.size
        return pa.concat_arrays(order)

    def _joined(self, words: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        runs = [words[k : k + JOINED] for k in range(0, len(words), JOINED)]
        texts = [" ".join(run) for run in runs]
        for run, encoded in zip(runs, self.tokenizer.encode_batch_fast(texts, add_special_tokens=False), strict=True):
            ids = np.array(encoded.ids, np.int32)
            ends = np.flatnonzero(self.ends[ids]) + 1
            if len(ends) == len(run):
                yield ids, np.diff(ends, prepend=0)
            else:
                yield from self._one_by_one(run)

    def _one_by_one(self, parts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        for k in range(0, len(parts), JOINED):
            run = parts[k : k + JOINED]
            encoded = self.tokenizer.encode(run, is_pretokenized=True, add_special_tokens=False)
            words = np.array(encoded.word_ids, np.int64)
            yield np.array(encoded.ids, np.int32), np.bincount(words, minlength=len(run))
