"""Encoding whole texts with a public tokenizer file, quickly and with bounded memory.

The tokenizer (a word-level BPE that drops white space) splits a text into units before it merges
anything, and encodes each unit on its own, so a text's ids are the ids of its units in order.
Units repeat, so each Python worker remembers the ids of those it has seen, and only new ones go
through the library.  The memory is emptied when it reaches a fixed number of entries, which
changes speed, never results.  Units are the tokenizer's own pieces where a text is Latin-1, and
white-space-free chunks otherwise.  A text with a special token's string, or with one of the
control characters that Python and the tokenizer split differently, goes through the library as a
whole.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterable, Iterator

import numpy as np

MAX_UNITS = 300_000       # units a worker remembers
GROUP_CHARS = 1 << 20     # texts are encoded in groups of about this many characters
SEGMENT = 1 << 22         # longer texts are cut at white space first

# The tokenizer's own pre-split, for lower-case Latin-1 (fixed value of the tokenizer file).
_PIECES = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-zªµºß-öø-ÿ]+|[0-9²³¹¼½¾]|[^\\sa-zªµºß-öø-ÿ0-9²³¹¼½¾]+")
_ODD = ("<|", "\x1c", "\x1d", "\x1e", "\x1f")
_SPACE = re.compile(r"[ \t\n\r\f\v]")


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class _Units(dict):
    """unit -> number; a missing one gets the next number and waits to be encoded."""

    def __init__(self) -> None:
        super().__init__()
        self.waiting: list[str] = []

    def __missing__(self, unit: str) -> int:
        number = self[unit] = len(self)
        self.waiting.append(unit)
        return number


class Encoder:
    def __init__(self, path: str) -> None:
        # Spark's tasks are the parallelism; the library's own threads would only compete with them.
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self._clear()

    def _clear(self) -> None:
        self.units = _Units()
        self.first = np.zeros(1024, np.int64)    # of each unit's ids in the pool
        self.length = np.zeros(1024, np.int64)
        self.pool = np.zeros(4096, np.uint32)
        self.used = 0

    def _encode_waiting(self) -> None:
        waiting, self.units.waiting = self.units.waiting, []
        if not waiting:
            return
        merge = self.tokenizer.model.tokenize
        rest = [w for w in waiting if not (w.isascii() and w.isalpha())]
        encoded = iter(self.tokenizer.encode_batch(rest, add_special_tokens=False))
        ids: list[int] = []
        ends = []
        for w in waiting:
            if w.isascii() and w.isalpha():     # one piece, and bytes are their own letters
                ids.extend([t.id for t in merge(w.lower())])
            else:
                ids.extend(next(encoded).ids)
            ends.append(len(ids))
        n0, n1 = len(self.units) - len(waiting), len(self.units)
        while n1 > len(self.first):
            self.first = np.concatenate([self.first, np.zeros_like(self.first)])
            self.length = np.concatenate([self.length, np.zeros_like(self.length)])
        while self.used + len(ids) > len(self.pool):
            self.pool = np.concatenate([self.pool, np.zeros_like(self.pool)])
        ends_ = np.asarray(ends, np.int64)
        starts = np.concatenate([[0], ends_[:-1]])
        self.first[n0:n1] = self.used + starts
        self.length[n0:n1] = ends_ - starts
        self.pool[self.used:self.used + len(ids)] = ids
        self.used += len(ids)

    def _numbers(self, text: str) -> np.ndarray:
        try:
            text.encode("latin-1")
            units = _PIECES.findall(text.lower())
        except UnicodeEncodeError:
            units = text.split()
        return np.fromiter(map(self.units.__getitem__, units), np.int64, len(units))

    def _group(self, texts: list[str], counts: bool) -> list:
        """Ids (or only their number) of each of a few texts."""
        if len(self.units) > MAX_UNITS:
            self._clear()
        odd = [any(x in t for x in _ODD) for t in texts]
        numbers = [self._numbers("" if o else t) for t, o in zip(texts, odd)]
        self._encode_waiting()
        every = np.concatenate(numbers) if numbers else np.zeros(0, np.int64)
        lengths = self.length[every]
        ends = np.concatenate([[0], np.cumsum(lengths)])
        at = ends[np.concatenate([[0], np.cumsum([len(x) for x in numbers], dtype=np.int64)])]
        if counts:
            out: list = np.diff(at).tolist()
        else:
            where = np.repeat(self.first[every] - ends[:-1], lengths) + np.arange(ends[-1])
            ids = self.pool[where]
            out = [ids[a:b] for a, b in zip(at[:-1], at[1:])]
        for i, o in enumerate(odd):
            if o:
                found = self.tokenizer.encode(texts[i], add_special_tokens=False).ids
                out[i] = len(found) if counts else np.asarray(found, np.uint32)
        return out

    def _run(self, texts: Iterable[str | None], counts: bool) -> Iterator:
        held: list[str] = []
        chars = 0
        for text in texts:
            text = text or ""
            if len(text) > SEGMENT and not any(x in text for x in _ODD):
                if held:
                    yield from self._group(held, counts)
                    held, chars = [], 0
                parts = [self._group([s], counts)[0] for s in _segments(text)]
                yield sum(parts) if counts else np.concatenate(parts)
                continue
            held.append(text)
            chars += len(text)
            if chars >= GROUP_CHARS:
                yield from self._group(held, counts)
                held, chars = [], 0
        if held:
            yield from self._group(held, counts)

    def ids(self, texts: Iterable[str | None]) -> Iterator[np.ndarray]:
        """One uint32 array per text, in order; None counts as empty."""
        return self._run(texts, counts=False)

    def counts(self, texts: Iterable[str | None]) -> Iterator[int]:
        """The number of ids of each text."""
        return self._run(texts, counts=True)


def _segments(text: str) -> Iterator[str]:
    at = 0
    while at < len(text):
        cut = _SPACE.search(text, min(at + SEGMENT, len(text)))
        end = cut.start() + 1 if cut else len(text)
        yield text[at:end]
        at = end


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """This worker's encoder for a tokenizer file."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]
