"""Sets of five-word shingles and their MinHash signatures, computed for batches of texts with numpy."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

WORDS = 5
BANDS, ROWS = 32, 4
HASHES = BANDS * ROWS
GROUP = 1 << 21  # bytes of text worked on together

_RANDOM = np.random.default_rng(20240229)
_WORD_FACTORS = _RANDOM.integers(1, 1 << 63, WORDS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_LENGTH_MARKS = _RANDOM.integers(1, 1 << 63, WORDS + 1, dtype=np.uint64)
_FACTORS = _RANDOM.integers(1, 1 << 31, HASHES, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
_SHIFTS = _RANDOM.integers(0, 1 << 32, HASHES, dtype=np.uint32)
_BAND_MARKS = _RANDOM.integers(1, 1 << 63, BANDS, dtype=np.uint64)


def mixed(values: np.ndarray) -> np.ndarray:
    """A one-to-one scrambling of 64-bit numbers (the finalizer of SplitMix64)."""
    values = (values ^ values >> np.uint64(30)) * np.uint64(0xBF58476D1CE4E5B9)
    values = (values ^ values >> np.uint64(27)) * np.uint64(0x94D049BB133111EB)
    return values ^ values >> np.uint64(31)


def groups(texts: pa.Array, size: int = GROUP) -> Iterator[pa.Array]:
    """Slices of about ``size`` bytes."""
    sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
    which = np.cumsum(sizes) // size
    cuts = [0, *(np.flatnonzero(np.diff(which)) + 1).tolist(), len(texts)]
    for start, stop in zip(cuts, cuts[1:]):
        if stop > start:
            yield texts.slice(start, stop - start)


def words_of(texts: pa.Array, lower: bool = True) -> tuple[pa.DictionaryArray, np.ndarray]:
    """All words of the texts, A-Z in lower case unless told otherwise, and where each text's words end. Words are runs
    of anything but the ASCII spaces; null texts have none."""
    texts = pc.fill_null(texts, "")
    split = pc.ascii_split_whitespace(pc.ascii_lower(texts) if lower else texts)
    ends = split.offsets.to_numpy()[1:] - split.offsets[0].as_py()
    flat = split.flatten()
    full = pc.not_equal(pc.binary_length(flat), 0).to_numpy(zero_copy_only=False)
    before = np.concatenate([[0], np.cumsum(full)])
    return flat.filter(pa.array(full)).dictionary_encode(), before[ends]


def shingle_sets(texts: pa.Array) -> Iterator[np.ndarray]:
    """The sorted 64-bit hashes of each text's shingles. A text of fewer words has its whole sequence as one."""
    for part in groups(texts):
        words, ends = words_of(part)
        known = np.array([xxhash.xxh3_64_intdigest(word) for word in words.dictionary.to_pylist()], np.uint64)
        hashed = known[words.indices.to_numpy()] if len(known) else known
        total = np.zeros(max(0, len(hashed) - WORDS + 1), np.uint64)
        for k in range(WORDS):
            total += hashed[k : k + len(total)] * _WORD_FACTORS[k]
        all_shingles = mixed(total + _LENGTH_MARKS[WORDS])
        start = 0
        for end in ends.tolist():
            n = end - start
            if n >= WORDS:
                yield np.unique(all_shingles[start : end - WORDS + 1])
            elif n:
                few = (hashed[start:end] * _WORD_FACTORS[:n]).sum(dtype=np.uint64) + _LENGTH_MARKS[n]
                yield mixed(np.array([few], np.uint64))
            else:
                yield np.zeros(0, np.uint64)
            start = end


def signature(shingles: np.ndarray) -> np.ndarray:
    """``HASHES`` minima of a set of at least one."""
    low = (shingles >> np.uint64(32)).astype(np.uint32)
    least = np.full(HASHES, np.iinfo(np.uint32).max, np.uint32)
    for start in range(0, len(low), 2048):
        np.minimum(least, (low[start : start + 2048, None] * _FACTORS + _SHIFTS).min(axis=0), out=least)
    return least


def band_keys(signatures: np.ndarray) -> np.ndarray:
    """One 64-bit key for each band of each signature."""
    rows = signatures.reshape(len(signatures), BANDS, ROWS).astype(np.uint64)
    key = np.broadcast_to(_BAND_MARKS, rows.shape[:2])
    for k in range(ROWS):
        key = mixed(key + rows[:, :, k])
    return key
