"""64-bit hashes of words and word shingles, vectorised per text."""

from __future__ import annotations

import numpy as np
import xxhash

_STEP = np.uint64(0xD1342543DE82EF95)


def mix(x: np.ndarray) -> np.ndarray:
    """Scramble 64-bit values one to one."""
    x = x.astype(np.uint64, copy=True)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x ^= x >> np.uint64(shift)
        x *= np.uint64(factor)
    x ^= x >> np.uint64(31)
    return x


def shingle_set(text: str | None, width: int = 5) -> np.ndarray:
    """Sorted distinct hashes of the runs of ``width`` words, A-Z lower-cased; a shorter text is one run; no words, none."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    codes = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    width = min(width, len(words))
    run = np.full(len(words) - width + 1, np.uint64(width))
    for k in range(width):
        run *= _STEP
        run += codes[k : len(codes) - width + 1 + k]
    run = mix(run)
    run.sort()
    return run[np.concatenate([[True], run[1:] != run[:-1]])]


def set_id(shingles: np.ndarray) -> int:
    """One signed 64-bit value for a whole set."""
    return int(np.frombuffer(xxhash.xxh3_64_digest(shingles.tobytes()), np.int64)[0])
