"""Words of a text as numbers, in numpy: one 64-bit hash per word, and hashes of word windows.

A word is a run of ``[0-9A-Za-z]`` and bytes above 0x7F of the UTF-8 text, A-Z lower-cased. Hashes
are the same in every process and run.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np

WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
#: Words in a shingle.
SHINGLE = 5
#: Texts are hashed in pieces of about this many bytes, so that memory stays bounded for any text.
PIECE = 1 << 20

_GAP = re.compile(rb"[^0-9A-Za-z\x80-\xff]")
_SPREAD = 4096  # places in a word that have weights of their own
_rng = np.random.Generator(np.random.PCG64(20_240_501))
_odd = lambda n: _rng.integers(1 << 62, 1 << 63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BYTE, _PLACE, _WINDOW, _LABEL = _odd(256), _odd(_SPREAD), _odd(64), _odd(1)[0]
_IS_WORD = np.zeros(256, bool)
for _lo, _hi in ((0x30, 0x3A), (0x41, 0x5B), (0x61, 0x7B), (0x80, 0x100)):
    _IS_WORD[_lo:_hi] = True
_BYTE[0x41:0x5B] = _BYTE[0x61:0x7B]
_BYTE[~_IS_WORD] = 0


def mix(x: np.ndarray) -> np.ndarray:
    """A one-to-one scrambling of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def pieces(raw: bytes) -> Iterator[bytes]:
    start = 0
    while len(raw) - start > PIECE:
        gap = _GAP.search(raw, start + PIECE)
        if gap is None:
            break
        yield raw[start : gap.end()]
        start = gap.end()
    yield raw[start:]


def word_hashes(raw: bytes) -> np.ndarray:
    """One 64-bit hash per word, in text order."""
    found = []
    for piece in pieces(raw):
        data = np.frombuffer(piece, np.uint8)
        inside = np.zeros(len(data) + 2, np.int8)
        inside[1:-1] = _IS_WORD[data]
        starts = np.flatnonzero(np.diff(inside) == 1)
        if len(starts):
            data = data[starts[0] :]
            starts = starts - starts[0]
            place = np.arange(len(data)) - np.repeat(starts, np.diff(starts, append=len(data)))
            found.append(mix(np.add.reduceat(_BYTE[data] * _PLACE[place & (_SPREAD - 1)], starts)))
    return np.concatenate(found) if found else np.empty(0, np.uint64)


def window_hashes(words: np.ndarray, size: int = SHINGLE) -> np.ndarray:
    """One hash for each window of ``size`` words; a shorter text is one window, an empty one none."""
    if not len(words):
        return words
    size = min(size, len(words))
    total = np.zeros(len(words) - size + 1, np.uint64)
    for k in range(size):
        total += words[k : len(words) - size + 1 + k] * _WINDOW[k]
    return mix(total + np.uint64(size))


def label_occurrences(values: np.ndarray) -> np.ndarray:
    """Equal values told apart by how often each occurred before, as new hashes."""
    order = np.argsort(values, kind="stable")
    ordered = values[order]
    first = np.concatenate([[True], ordered[1:] != ordered[:-1]]) if len(values) else np.empty(0, bool)
    begins = np.flatnonzero(first)
    seen = np.empty(len(values), np.uint64)
    seen[order] = (np.arange(len(values)) - np.repeat(begins, np.diff(begins, append=len(values)))).astype(np.uint64)
    return mix(values + seen * _LABEL)
