"""Byte-level BPE ids through the tokenizers library, with a cache of word pieces.

In a byte-level BPE with the usual word pattern, a single ASCII space between
two characters that are not white space always starts a new pre-token (it is
glued to the word after it). So a text may be cut there and the pieces encoded
apart: their ids, in order, are the ids of the whole text. Words repeat, so
each distinct piece goes through the library once per worker (tests compare
with encoding whole texts).
"""

from __future__ import annotations

import gc
import os
import re
from itertools import chain, count

import numpy as np

from salesmart.llm.common import resident

VOCABULARY = "byte_bpe_50k.json"
_GAP = re.compile(r"(?<=\S) (?=\S)")
_LETTERS = "[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+"
_POINTS = "[.,;:!?%#$&*-]"
#: A piece whose pre-tokens are plain to see: letters, a run of punctuation, and perhaps the same after a line's end.
_PLAIN = re.compile(f"( ?{_LETTERS})({_POINTS}*)(?:(\n)({_LETTERS})({_POINTS}*))?")


def _byte_letters() -> list[str]:
    """The letter that stands for each byte in a byte-level BPE (fixed by its format):
    printable Latin-1 characters stand for themselves, the rest follow from U+0100."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in own]
    return [chr(b) if b in own else chr(0x100 + rest.index(b)) for b in range(256)]


class _Pieces(dict):
    """Piece -> its number; a new piece goes to ``fresh`` with what leads it."""

    def __init__(self, fresh: list[str], lead: str):
        super().__init__()
        self.fresh, self.lead, self.numbers = fresh, lead, None

    def __missing__(self, piece: str) -> int:
        number = self[piece] = next(self.numbers)
        self.fresh.append(self.lead + piece)
        return number


class Encoder:
    """Ids of texts. The cache is emptied when it holds ``max_pieces``, which bounds its memory."""

    def __init__(self, path: str, max_pieces: int = 600_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True  # their strings in a text are ordinary text
        self.max_pieces = max_pieces
        self.letters = dict(enumerate(_byte_letters()))
        self._empty()

    def _empty(self) -> None:
        self.fresh: list[str] = []
        self.whole, self.later = _Pieces(self.fresh, ""), _Pieces(self.fresh, " ")
        self.whole.numbers = self.later.numbers = count()
        self.pre_tokens: dict[str, tuple[int, ...]] = {}
        self.known = 0
        self.flat = np.zeros(1 << 16, np.uint32)
        self.starts = np.zeros((1 << 14) + 1, np.int64)
        self.odd = np.zeros(1 << 14, bool)  # later pieces beside which there is more white space

    def _pre_token(self, text: str) -> tuple[int, ...]:
        spelt = text.replace(" ", self.letters[0x20]) if text.isascii() else text.encode().decode("latin-1").translate(self.letters)
        ids = self.pre_tokens[text] = tuple([t.id for t in self.tokenizer.model.tokenize(spelt.replace("\n", self.letters[0x0A]))])
        return ids

    def _learn(self) -> None:
        """Ids of the pieces not met before: plain ones by the library's BPE model alone,
        others by its whole pipeline."""
        if not self.fresh:
            return
        ids, others, seen, plain = [], [], self.pre_tokens, _PLAIN.fullmatch
        for n, word in enumerate(self.fresh):
            if found := plain(word):
                own: list[int] = []
                for pre in found.groups():
                    if pre:
                        own += seen.get(pre) or self._pre_token(pre)
                ids.append(own)
            else:
                ids.append(())
                others.append(n)
        fresh = [self.fresh[n] for n in others]
        for n, encoded in zip(others, self.tokenizer.encode_batch_fast(fresh, add_special_tokens=False), strict=True):
            ids[n] = encoded.ids
        lengths = np.fromiter(map(len, ids), np.int64, len(ids))
        end = self.known + len(ids)
        if end + 1 > len(self.starts):
            self.starts = np.concatenate([self.starts, np.zeros(max(end, len(self.starts)), np.int64)])
            self.odd = np.concatenate([self.odd, np.zeros(max(end, len(self.odd)), bool)])
        self.odd[[self.known + n for n, w in zip(others, fresh, strict=True)
                  if w and (w[-1].isspace() or w[0] == " " and w[1].isspace())]] = True
        at = int(self.starts[self.known])
        self.starts[self.known + 1:end + 1] = at + np.cumsum(lengths)
        need = int(self.starts[end])
        if need > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros(max(need, len(self.flat)), np.uint32)])
        self.flat[at:need] = np.fromiter(chain.from_iterable(ids), np.uint32, need - at)
        self.known = end
        self.fresh.clear()

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids of ``texts`` in one array, and the number of ids of each text.

        The cache holds no cycles, and searching it for some, again and again
        as it grows, takes a quarter of the time; so that is off meanwhile.
        """
        collecting = gc.isenabled()
        gc.disable()
        try:
            return self._encode(texts)
        finally:
            if collecting:
                gc.enable()

    def _encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        if self.known > self.max_pieces:
            self._empty()
        rows, whole, later = [], self.whole, self.later
        for t in texts:
            parts = t.split(" ")
            rows.append([whole[parts[0]], *map(later.__getitem__, parts[1:])])
        self._learn()
        counts = np.fromiter(map(len, rows), np.int64, len(rows))
        numbers = np.fromiter(chain.from_iterable(rows), np.int64, int(counts.sum()))
        # Texts with a space beside more white space are cut again where it is safe.
        of = np.repeat(np.arange(len(rows)), counts)
        for i in np.unique(of[self.odd[numbers]]).tolist():
            parts = _GAP.split(texts[i])
            rows[i] = [whole[parts[0]], *(whole[" " + p] for p in parts[1:])]
            counts[i] = -1
        if (counts < 0).any():
            self._learn()
            counts = np.fromiter(map(len, rows), np.int64, len(rows))
            numbers = np.fromiter(chain.from_iterable(rows), np.int64, int(counts.sum()))
        lengths = self.starts[numbers + 1] - self.starts[numbers]
        ends = np.cumsum(lengths)
        total = int(ends[-1]) if len(ends) else 0
        where = np.repeat(self.starts[numbers] - (ends - lengths), lengths) + np.arange(total)
        edges = np.concatenate([[0], ends])[np.concatenate([[0], np.cumsum(counts)])]
        return self.flat[where], np.diff(edges)


def vocabulary_path() -> str:
    import public_tokenizers

    return public_tokenizers.path(VOCABULARY)


def encoder(path: str | None, max_pieces: int = 600_000) -> Encoder:
    """The worker's encoder for ``path`` (None: the public vocabulary as installed on the worker). Its
    cache takes about 400 bytes a piece."""
    return resident(f"encoder {path} {max_pieces}", lambda: Encoder(path or vocabulary_path(), max_pieces))


def with_end(ids: np.ndarray, lengths: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """``end_id`` after each text's ids; returns all ids and the first index of each text, and the end."""
    edges = np.concatenate([[0], np.cumsum(lengths + 1)])
    out = np.empty(int(edges[-1]), np.uint32)
    ends = np.zeros(len(out), bool)
    ends[edges[1:] - 1] = True
    out[ends], out[~ends] = end_id, ids
    return out, edges
