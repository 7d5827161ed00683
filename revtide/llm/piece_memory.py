"""Token ids of text pieces, by a tokenizer that is asked once for each part.

A tokenizer that cuts its text before merging gives the text between two certain
cuts the same tokens wherever it stands.  Most words of a corpus repeat, with
other punctuation after them, so a worker remembers pieces and their parts; the
memory is bounded.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Sequence
from itertools import chain
from typing import Any

import numpy as np
from tokenizers import Tokenizer

from revtide.llm.common import pieces

#: Entries in each of the two halves of a memory.
HALF = 300_000
#: Parts of one call of the tokenizer.
CALL = 512
#: Pieces of documents that are looked up together.
BULK = 100_000

_STOPS = ".,;:!?"
#: Letters below this are letters to every library.
_PLAIN = "\u0250"


def _letters(text: str) -> bool:
    return text.isalpha() and (text.isascii() or max(text) < _PLAIN)


def parts_of(piece: str | bytes) -> tuple[str, str]:
    """A word of letters, a space before it included, and the stops after it.

    Every tokenizer here cuts between letters and stops.  Anything else is one
    part and has no second.
    """
    if isinstance(piece, bytes):
        piece = piece.decode("utf-8", "replace")
    word = piece.rstrip(_STOPS)
    if len(word) < len(piece) and _letters(word[1:] if word[:1] == " " else word):
        return word, piece[len(word) :]
    return piece, ""


class _Halves:
    """A dictionary that forgets the older half of what it has not been asked for."""

    def __init__(self, half: int) -> None:
        self.half = half
        self.young: dict[Any, Any] = {}
        self.old: dict[Any, Any] = {}

    def turn(self) -> None:
        if len(self.young) > self.half:
            self.old, self.young = self.young, {}

    def missing(self, names: Iterable) -> list:
        """Names it does not know; those that it knows are young afterwards."""
        young, old, out = self.young, self.old, []
        for name in names:
            if name not in young:
                if (value := old.get(name)) is None:
                    out.append(name)
                else:
                    young[name] = value
        return out


class PieceMemory:
    """Values of pieces.

    ``make`` turns token ids and the places where parts begin and end into the
    parts' values, ``+`` joins the values of parts, and ``plain`` may give parts
    with the same tokens one form.

    Words of letters are encoded many at a time, in one text: ``glue`` stands
    between them, and tokens that ``edge`` holds for are the ones that end a
    word, or begin one if ``leads``.
    """

    def __init__(
        self,
        tokenizer: Tokenizer,
        make: Callable[[np.ndarray, np.ndarray], list],
        edge: Callable[[str], bool],
        leads: bool,
        glue: str = "",
        plain: Callable[[str], str] = str,
        half: int = HALF,
    ) -> None:
        self.tokenizer, self.make, self.plain = tokenizer, make, plain
        self.leads, self.glue = leads, glue
        self.whole, self.parts = _Halves(half), _Halves(half)
        vocabulary = tokenizer.get_vocab()
        self.edges = np.zeros(max(vocabulary.values(), default=0) + 1, bool)
        self.edges[[number for token, number in vocabulary.items() if edge(token)]] = True

    def values(self, text_pieces: Sequence) -> list:
        """The value of each piece, non-empty text or UTF-8 bytes."""
        found = list(map(self.whole.young.get, text_pieces))
        if None not in found:
            return found
        young, plain = self.whole.young, self.plain
        unknown = {piece for piece, value in zip(text_pieces, found, strict=True) if value is None}
        new = self.whole.missing(unknown)
        heads, tails = zip(*map(parts_of, new), strict=True) if new else ((), ())
        heads = list(map(plain, heads))
        known = self._known({*heads, *tails} - {""})
        for piece, head, tail in zip(new, heads, tails, strict=True):
            young[piece] = known[head] + known[tail] if tail else known[head]
        out = [young[piece] if value is None else value for piece, value in zip(text_pieces, found, strict=True)]
        self.whole.turn()
        return out

    def of_documents(self, documents: Iterable[Sequence]) -> Iterator[list]:
        """The values of each document's pieces; documents are looked up together."""
        held: list[Sequence] = []
        size = 0
        for document in documents:
            held.append(document)
            size += len(document)
            if size >= BULK:
                yield from self._split(held)
                held, size = [], 0
        yield from self._split(held)

    def _split(self, held: list[Sequence]) -> Iterator[list]:
        values = self.values(list(chain.from_iterable(held)))
        at = 0
        for document in held:
            yield values[at : at + len(document)]
            at += len(document)

    def _known(self, wanted: set[str]) -> dict[str, Any]:
        self.parts.turn()
        new = self.parts.missing(wanted)
        lead = " " if self.leads else ""
        words = [part for part in new if part[: len(lead)] == lead and _letters(part[len(lead) :])]
        for some in pieces(words, CALL):
            self._learn(some, self._words(some))
        others = set(new).difference(words)
        for some in pieces(sorted(others), CALL):
            self._learn(some, self._one_by_one(some))
        return self.parts.young

    def _learn(self, parts: list[str], values: list) -> None:
        self.parts.young.update(zip(parts, values, strict=True))

    def _words(self, words: list[str]) -> list:
        (encoded,) = self.tokenizer.encode_batch_fast([self.glue.join(words)], add_special_tokens=False)
        ids = np.array(encoded.ids, dtype=np.uint32)
        at = np.flatnonzero(self.edges[ids])
        if len(at) != len(words):
            return self._one_by_one(words)
        return self.make(ids, np.append(at, len(ids)) if self.leads else np.append(0, at + 1))

    def _one_by_one(self, parts: list[str]) -> list:
        encoded = self.tokenizer.encode(parts, is_pretokenized=True, add_special_tokens=False)
        words = np.array(encoded.word_ids, dtype=np.int64)
        return self.make(np.array(encoded.ids, dtype=np.uint32), np.searchsorted(words, np.arange(len(parts) + 1)))
