"""Word shingles as 64-bit hashes, many texts at a time, and HyperMinHash registers over them."""

from __future__ import annotations

import hashlib
from functools import lru_cache

import numpy as np

from tidewire.llm.common import mix, word_hashes

WORDS = 5
#: Registers, and those of one band. A register holds the leading zeros of its least hash and MANTISSA bits after them.
REGISTERS, ROWS, MANTISSA = 192, 4, 10
BANDS = REGISTERS // ROWS


def shingle_sets(raw: np.ndarray, offsets: np.ndarray, words: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each text, sorted within the text, and the n + 1 offsets into them.

    A text with fewer words than a shingle has one shingle of all its words; one without words has none.
    """
    hashes, owner, _ = word_hashes(raw, offsets)
    n = len(offsets) - 1
    counts = np.bincount(owner, minlength=n)
    first = np.concatenate([[0], np.cumsum(counts)])
    # Position i starts a shingle if its text has `words` words from i on; short texts start one at their first word.
    at = np.arange(len(hashes))
    left = first[owner + 1] - at
    starts = (left >= words) | ((counts[owner] < words) & (at == first[owner]))
    begin = at[starts]
    length = np.minimum(left[starts], words)
    value = np.zeros(len(begin), np.uint64)
    for k in range(words):
        more = length > k
        value[more] = mix(value[more] * np.uint64(3) + hashes[begin[more] + k] + np.uint64(k + 1))
    mine = owner[begin]
    order = np.lexsort((value, mine))
    value, mine = value[order], mine[order]
    fresh = np.ones(len(value), bool)
    fresh[1:] = (value[1:] != value[:-1]) | (mine[1:] != mine[:-1])
    value, mine = value[fresh], mine[fresh]
    return value, np.concatenate([[0], np.cumsum(np.bincount(mine, minlength=n))])


def registers(value: np.ndarray, offsets: np.ndarray, size: int = REGISTERS, mantissa: int = MANTISSA) -> np.ndarray:
    """HyperMinHash registers of each set: 0 if empty, else leading zeros of the least hash plus one, and its next bits."""
    n = len(offsets) - 1
    owner = np.repeat(np.arange(n), np.diff(offsets))
    h = mix(value + np.uint64(0x632BE59BD9B4E019))
    cell = owner * size + ((h >> np.uint64(40)) % np.uint64(size)).astype(np.int64)
    rest = mix(h + np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(11)  # 53 bits, independent of the register's choice
    least = np.full(n * size, 1 << 53, np.int64)
    np.minimum.at(least, cell, rest.astype(np.int64))
    filled = least < (1 << 53)
    zeros = 53 - np.frexp(least.astype(np.float64))[1]
    zeros = np.where(least == 0, 53, zeros)
    kept = np.minimum(zeros, (1 << (16 - mantissa)) - 2)
    after = np.maximum(0, 53 - kept - 1 - mantissa)
    bits = (least >> after) & ((1 << mantissa) - 1)
    return np.where(filled, ((kept + 1) << mantissa) | bits, 0).astype(np.uint16).reshape(n, size)


def sketches(value: np.ndarray, offsets: np.ndarray) -> list[bytes]:
    """A bit for each of some cells of each set, as many as shingles or up to twice that: is an odd number of them in it?"""
    n = np.diff(offsets)
    bits = np.int64(1) << np.maximum(6, np.ceil(np.log2(np.maximum(n, 1)))).astype(np.int64)
    first = np.concatenate([[0], np.cumsum(bits)])
    cell = np.repeat(first[:-1], n) + (value & np.repeat(bits - 1, n).astype(np.uint64)).astype(np.int64)
    packed = np.packbits((np.bincount(cell, minlength=first[-1]) & 1).astype(np.uint8), bitorder="little")
    return [packed[a:b].tobytes() for a, b in zip(first[:-1] // 8, first[1:] // 8, strict=True)]


def folded(sketch: bytes, size: int) -> np.ndarray:
    """The sketch that the set has in ``size`` bytes, no more than it holds."""
    return np.bitwise_xor.reduce(np.frombuffer(sketch, np.uint8).reshape(-1, size), axis=0)


def unlike(a: bytes, b: bytes) -> int:
    """How many cells tell two sets apart: no more than the shingles that one of them alone has."""
    size = min(len(a), len(b))
    return int(np.bitwise_count(folded(a, size) ^ folded(b, size)).sum(dtype=np.int64))


def may_link(apart: int | np.ndarray, n_a: int | np.ndarray, n_b: int | np.ndarray) -> bool | np.ndarray:
    """Linked sets share at least 3/7 of their two sizes, so at most 1/7 of them lies in one set alone."""
    return 7 * apart <= n_a + n_b


def band_keys(regs: np.ndarray, rows: int = ROWS) -> tuple[np.ndarray, np.ndarray]:
    """(set number, key) for each band with a filled register; equal keys are equal bands."""
    n, size = regs.shape
    packed = np.zeros((n, size // rows), np.uint64)
    for r in range(rows):
        packed = (packed << np.uint64(16)) | regs[:, r::rows].astype(np.uint64)
    own, band = np.nonzero(packed)
    return own, mix(packed[own, band] + mix(band.astype(np.uint64) + np.uint64(1))).view(np.int64)


def jaccard(a: np.ndarray, b: np.ndarray, n_a: int, n_b: int, mantissa: int = MANTISSA) -> float:
    """Estimated similarity: the share of equal registers, less the collisions expected of unrelated sets of these sizes."""
    filled = (a > 0) | (b > 0)
    total = int(filled.sum())
    if not total:
        return 0.0
    share = int(((a == b) & filled).sum()) / total
    by_chance = expected_collisions(n_a / len(a), n_b / len(a), mantissa)
    return max(0.0, (share - by_chance) / (1 - by_chance))


def jaccard_of(left: np.ndarray, right: np.ndarray, n_left: np.ndarray, n_right: np.ndarray) -> np.ndarray:
    """``jaccard`` of many pairs of register rows; set sizes are taken to the next step of an eighth of an octave."""
    filled = (left > 0) | (right > 0)
    total = filled.sum(1)
    share = ((left == right) & filled).sum(1) / np.maximum(total, 1)
    steps = [np.rint(8 * np.log2(np.maximum(n, 1))).astype(np.int64) for n in (n_left, n_right)]
    low, high = np.minimum(*steps), np.maximum(*steps)
    sizes, where = np.unique(low * 1024 + high, return_inverse=True)
    chance = np.array([_collisions_of_steps(int(s) // 1024, int(s) % 1024) for s in sizes])[where]
    return np.where(total > 0, np.maximum(0.0, (share - chance) / (1 - chance)), 0.0)


@lru_cache(maxsize=4096)
def _collisions_of_steps(low: int, high: int) -> float:
    return expected_collisions(2 ** (low / 8) / REGISTERS, 2 ** (high / 8) / REGISTERS)


def expected_collisions(x: float, y: float, mantissa: int = MANTISSA) -> float:
    """Chance that the registers of two unrelated sets with ``x`` and ``y`` elements in a register agree."""
    zeros = np.arange(64, dtype=np.float64)[:, None]
    step = np.arange(1 << mantissa, dtype=np.float64)[None, :]
    low = 2.0 ** -(zeros + 1) * (1 + step / (1 << mantissa))
    high = low + 2.0 ** -(zeros + 1) / (1 << mantissa)
    least = lambda k: np.exp(-k * low) - np.exp(-k * high)
    either = 1 - np.exp(-x) * np.exp(-y)
    return float((least(x) * least(y)).sum() / either) if either > 0 else 0.0


def linked(inter: int | np.ndarray, n_a: int | np.ndarray, n_b: int | np.ndarray) -> bool | np.ndarray:
    return 100 * inter >= 75 * (n_a + n_b - inter)


def set_digest(values: np.ndarray) -> bytes:
    return hashlib.blake2b(values.tobytes(), digest_size=16).digest()
