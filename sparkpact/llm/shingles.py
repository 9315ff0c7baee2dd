"""Sets of word shingles as sorted 64-bit hashes."""

from __future__ import annotations

import numpy as np

from sparkpact.llm.base import BYTE_VALUES, prefix_sums, runs_of, span_hashes

WORDS = 5
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32


def shingle_sets(data: np.ndarray, offsets: np.ndarray, width: int = WORDS) -> list[np.ndarray]:
    """The distinct shingles of each text, sorted: ``width`` words each, or all words of a shorter text; none without words."""
    ends = offsets[1:]
    gapped = np.insert(_FOLD[data], ends, 32)
    blank = (gapped == 32) | ((gapped >= 9) & (gapped <= 13))
    begin, end = runs_of(~blank)
    words = span_hashes(prefix_sums(BYTE_VALUES[gapped]), begin, end) | np.uint64(1)
    first = np.searchsorted(begin, offsets + np.arange(len(offsets)))
    # Shingles across two texts are hashed too and left out below.
    sums = prefix_sums(words)
    starts = np.arange(max(0, len(words) - width + 1))
    hashes = span_hashes(sums, starts, starts + width)
    out = []
    for a, b in zip(first[:-1].tolist(), first[1:].tolist()):
        if b - a >= width:
            out.append(np.unique(hashes[a : b - width + 1]))
        elif b > a:
            out.append(span_hashes(sums, np.array([a]), np.array([b])))
        else:
            out.append(np.zeros(0, np.uint64))
    return out
