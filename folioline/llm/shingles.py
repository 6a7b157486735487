"""Word shingles of texts: sets of 64-bit hashes of five words in a row."""

from __future__ import annotations

import numpy as np

from folioline.llm import arrays

WORDS = 5
PERCENT = 80
#: 64-bit words of a set's odd sketch.
SKETCH = 16


def word_hashes(t: arrays.Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hashes of the words `[^\\x20\\x09-\\x0D]+` after lowering A-Z, begin of each, words before each text)."""
    data = arrays.lower_ascii(t.data)
    begins, ends = arrays.runs(~arrays.SPACES[data], t.offsets)
    hashes = arrays.span_hashes(arrays.prefix_hashes(data), begins, ends)
    return hashes, begins, np.searchsorted(begins, t.offsets)


def sets_of(words: np.ndarray, edges: np.ndarray) -> list[np.ndarray]:
    """Ascending distinct shingles of each run of words; a run of fewer words than a shingle has is one by itself."""
    windows = arrays.window_hashes(words, WORDS)
    out = []
    for a, b in zip(edges[:-1].tolist(), edges[1:].tolist()):
        if b - a >= WORDS:
            out.append(np.unique(windows[a:b - WORDS + 1]))
        elif b > a:
            out.append(arrays.window_hashes(words[a:b], b - a) ^ np.uint64(b - a))
        else:
            out.append(words[:0])
    return out


def odd_sketch(items: np.ndarray) -> bytes:
    """A bit for each cell of a hash: whether the set has an odd number of members in it.

    Two sketches differ in at most as many bits as there are members that only one of the sets has.
    """
    cells = np.bincount((items >> np.uint64(20)).astype(np.int64) % (64 * SKETCH), minlength=64 * SKETCH)
    return np.packbits((cells & 1).astype(np.uint8)).tobytes()


def digest(items: np.ndarray) -> int:
    """One signed 64-bit number for a set."""
    with np.errstate(over="ignore"):
        x = arrays.mix(np.array([arrays.mix(items).sum(dtype=np.uint64) + np.uint64(len(items))], np.uint64))
    return int(x.view(np.int64)[0])
