"""Word shingles of whole texts as 64-bit numbers, computed over the bytes of an Arrow batch at once."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BYTES_AT_ONCE = 1_000_000
_RANDOM = np.random.default_rng(20240229)
_BYTE = _RANDOM.integers(0, 2**64, 256, np.uint64)
_BYTE[ord("A"):ord("Z") + 1] = _BYTE[ord("a"):ord("z") + 1]  # upper case counts as lower case
_SPACE = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])
_BASE = np.uint64(0x9E3779B97F4A7C15)
_PLACE = _RANDOM.integers(0, 2**64, 64, np.uint64) | np.uint64(1)


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hashes(raw: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each word of ``raw`` and the number of the text it is in; texts begin at ``starts``."""
    keep = ~_SPACE[raw]
    first = keep.copy()
    first[1:] &= ~keep[:-1]
    begins = starts[starts < len(raw)]
    first[begins] = keep[begins]
    at = np.flatnonzero(keep)
    if not len(at):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    heads = np.flatnonzero(first[at])
    sizes = np.diff(np.append(heads, len(at)))
    place = np.arange(len(at)) - np.repeat(heads, sizes)
    powers = np.cumprod(np.full(int(sizes.max()), _BASE, np.uint64))
    sums = np.add.reduceat(_BYTE[raw[at]] * powers[place], heads)
    return mix(sums + sizes.astype(np.uint64) * _BASE), np.searchsorted(starts, at[heads], side="right") - 1


def _words(raw: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """As ``word_hashes``, a bounded part at a time: a long text is cut at white space."""
    hashes, owners, low = [], [], 0
    while low < len(raw):
        high = min(len(raw), low + BYTES_AT_ONCE)
        while high < len(raw) and not _SPACE[raw[high]]:
            gap = np.flatnonzero(_SPACE[raw[high:high + BYTES_AT_ONCE]])
            high += int(gap[0]) if len(gap) else min(BYTES_AT_ONCE, len(raw) - high)
        base = int(np.searchsorted(starts, low, side="right")) - 1
        inside = np.append(0, starts[(starts > low) & (starts < high)] - low)
        # Empty texts share a start: number texts by the last one that begins at or before a word.
        h, o = word_hashes(raw[low:high], inside)
        numbers = np.append(base, np.flatnonzero((starts > low) & (starts < high)))
        hashes.append(h)
        owners.append(numbers[o])
        low = high
    none = np.zeros(0, np.uint64)
    return np.concatenate([none, *hashes]), np.concatenate([np.zeros(0, np.int64), *owners]).astype(np.int64)


def shingle_sets(texts: pa.Array, width: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles of each text, ascending, in a row; and how many each has.

    A text with fewer words than ``width`` has all of them as its one shingle; one without words has none.
    """
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    raw = np.frombuffer(data, np.uint8)[offsets[0]:offsets[-1]] if data is not None and offsets[-1] > offsets[0] else np.zeros(0, np.uint8)
    words, owner = _words(raw, offsets[:-1] - offsets[0])
    counts = np.bincount(owner, minlength=len(texts))
    ends = np.cumsum(counts)
    full = np.flatnonzero(owner[:-(width - 1) or None] == owner[width - 1:]) if len(words) >= width else np.zeros(0, np.int64)
    value = np.full(len(full), width, np.uint64)
    for k in range(width):
        value += words[full + k] * _PLACE[k]
    short = np.flatnonzero((counts > 0) & (counts < width))
    whole = counts[short].astype(np.uint64)
    for k in range(width - 1):
        there = counts[short] > k
        whole[there] += words[(ends - counts)[short][there] + k] * _PLACE[k]
    value, who = mix(np.append(value, whole)), np.append(owner[full], short)
    order = np.lexsort((value, who))
    value, who = value[order], who[order]
    new = np.ones(len(value), bool)
    new[1:] = (value[1:] != value[:-1]) | (who[1:] != who[:-1])
    return value[new], np.bincount(who[new], minlength=len(texts))


def set_signatures(values: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """128 bits per set that do not depend on order, as two signed columns."""
    ends = np.concatenate([[0], np.cumsum(sizes)])
    out = np.zeros((len(sizes), 2), np.uint64)
    for k in range(2):
        total = np.append(np.zeros(1, np.uint64), np.cumsum(mix(values ^ _PLACE[40 + k]), dtype=np.uint64))
        out[:, k] = mix((total[ends[1:]] - total[ends[:-1]]) ^ (sizes.astype(np.uint64) * _BASE))
    return out.view(np.int64)


def portions(batches: Iterator[pa.RecordBatch], size: int = BYTES_AT_ONCE) -> Iterator[pa.RecordBatch]:
    """Batches with about ``size`` bytes of ``text`` each; a longer text has one to itself."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy(zero_copy_only=False)
        group = np.cumsum(sizes) // size
        cuts = np.concatenate([[0], np.flatnonzero(np.diff(group)) + 1, [batch.num_rows]])
        for a, z in zip(cuts[:-1], cuts[1:]):
            if z > a:
                yield batch.slice(a, z - a)
