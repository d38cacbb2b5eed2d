"""Vectorised word finding in UTF-8 bytes."""

from __future__ import annotations

import numpy as np

from .common import byte_powers, mix64

#: Bytes of the words [^\x00-\x2F\x3A-\x60\x7B-\x7F]+ after lower-casing A-Z.
ALNUM = np.zeros(256, bool)
ALNUM[0x30:0x3A] = ALNUM[0x41:0x5B] = ALNUM[0x61:0x7B] = ALNUM[0x80:] = True
#: Bytes of the words [^\x20\x09-\x0D]+.
DARK = np.ones(256, bool)
DARK[0x09:0x0E] = DARK[0x20] = False
FOLD = np.arange(256, dtype=np.uint8)
FOLD[0x41:0x5B] += 32

BLOCK = 1 << 20
BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 1 << 64)
_POWERS = [np.empty(0, np.uint64), np.empty(0, np.uint64)]


def word_bounds(raw: np.ndarray, of: np.ndarray, cuts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of bytes in class ``of`` in raw, where
    no run crosses a row start in cuts."""
    inside = of[raw]
    step = np.empty(len(raw) + 1, bool)
    step[0], step[-1] = inside[:1].any(), inside[-1:].any()
    np.not_equal(inside[1:], inside[:-1], out=step[1:-1])
    edges = np.flatnonzero(step)
    starts, ends = edges[0::2], edges[1::2]
    # a row start inside a run begins a new word
    at = cuts[(cuts > 0) & (cuts < len(raw))]
    at = np.unique(at)
    at = at[inside[at] & inside[at - 1]] if len(at) else at
    if len(at):
        starts, ends = np.sort(np.concatenate([starts, at])), np.sort(np.concatenate([ends, at]))
    return starts, ends


def word_hashes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word's bytes that depends on nothing else.

    Sums of byte * base**position up to every byte give each word's sum by one
    subtraction; base**-start makes it the same wherever the word stands. Words are
    taken in blocks, so that a long text needs no more memory than a short one.
    """
    out = np.empty(len(starts), np.uint64)
    i = 0
    while i < len(starts):
        j = max(i + 1, int(np.searchsorted(ends, starts[i] + BLOCK, "right")))
        out[i:j] = _block_hashes(raw[starts[i] : ends[j - 1]], starts[i:j] - starts[i], ends[i:j] - starts[i])
        i = j
    return out


def _block_hashes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    while len(_POWERS[0]) < len(raw):
        n = max(BLOCK, len(raw))
        _POWERS[:] = [byte_powers(n, BASE), byte_powers(n, INVERSE)]
    sums = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * _POWERS[0][: len(raw)], out=sums[1:])
    lengths = (ends - starts).astype(np.uint64)
    return mix64((sums[ends] - sums[starts]) * _POWERS[1][starts] + (lengths << np.uint64(48)))
