"""Words and shingles of many texts at once, as 64-bit hashes in numpy arrays.

Texts come as one run of bytes with the offset of each text in it. Word hashes are
polynomials modulo 2^64 over random byte values, read off prefix sums, so that no Python
code runs per word. Equal words have equal hashes; unequal ones differ but for a chance of
about 2^-64.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U = np.uint64
GOLDEN = U(0x9E3779B97F4A7C15)
CHUNK_BYTES = 1 << 18
EMPTY = U(0xFFFFFFFFFFFFFFFF)


def mix64(values: np.ndarray) -> np.ndarray:
    """Scrambles 64-bit values one to one."""
    x = values ^ (values >> U(30))
    x *= U(0xBF58476D1CE4E5B9)
    x ^= x >> U(27)
    x *= U(0x94D049BB133111EB)
    x ^= x >> U(31)
    return x


_BASE = 0xD1342543DE82EF95  # odd, so it has an inverse modulo 2^64
_SPACES = [0x20, *range(0x09, 0x0E)]
IS_SPACE = np.isin(np.arange(256), _SPACES)
_UPPER = np.arange(256)
_FOLDED = np.where((_UPPER >= 0x41) & (_UPPER <= 0x5A), _UPPER + 32, _UPPER)
_VALUE = mix64(np.arange(1, 257, dtype=U) * GOLDEN)
_POWERS = [np.ones(1, U), np.ones(1, U)]


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, at least `n` of each."""
    if len(_POWERS[0]) < n:
        size = 1 << max(n - 1, 1).bit_length()
        for i, base in enumerate((_BASE, pow(_BASE, -1, 1 << 64))):
            powers = np.full(size, U(base))
            powers[0] = 1
            _POWERS[i] = np.cumprod(powers)
    return _POWERS[0], _POWERS[1]


def chunks(texts: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Runs of whole texts of about `limit` bytes: the bytes, and the offsets of the texts.

    A null text is empty. A longer text is a run of its own.
    """
    values = texts.cast(pa.large_binary())
    if values.null_count:
        values = pc.fill_null(values, b"")
    n = len(values)
    offsets = np.frombuffer(values.buffers()[1], np.int64)[values.offset : values.offset + n + 1]
    buffer = values.buffers()[2]
    data = np.zeros(0, np.uint8) if buffer is None else np.frombuffer(buffer, np.uint8)
    low = 0
    while low < n:
        high = int(np.searchsorted(offsets, offsets[low] + limit, "right")) - 1
        high = min(max(high, low + 1), n)
        yield data[offsets[low] : offsets[high]], offsets[low : high + 1] - offsets[low]
        low = high


def word_hashes(
    data: np.ndarray, offsets: np.ndarray, fold: bool = True
) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words (runs without space, tab to carriage return), and where each
    text's words start; with `fold`, A-Z count as a-z."""
    n = len(data)
    if not n:
        return np.zeros(0, U), np.zeros(len(offsets), np.int64)
    space = IS_SPACE[data]
    inner = offsets[1:-1]
    head = np.empty(n, bool)
    head[0], head[1:] = True, space[:-1]
    head[inner[inner < n]] = True
    head &= ~space
    tail = np.empty(n, bool)
    tail[-1], tail[:-1] = True, space[1:]
    tail[inner[inner > 0] - 1] = True
    tail &= ~space
    starts, ends = np.flatnonzero(head), np.flatnonzero(tail) + 1
    powers, inverse = _powers(n)
    sums = np.empty(n + 1, U)
    sums[0] = 0
    np.cumsum((_VALUE[_FOLDED] if fold else _VALUE)[data] * powers[:n], out=sums[1:])
    hashes = (sums[ends] - sums[starts]) * inverse[starts]
    hashes += (ends - starts).astype(U) * GOLDEN
    return mix64(hashes), np.searchsorted(starts, offsets)


def _weights(size: int) -> np.ndarray:
    return mix64(np.arange(101, 101 + size, dtype=U)) | U(1)


def shingles(words: np.ndarray, bounds: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each run of `size` words of each text, and where each text's runs start.

    A text with fewer words, but not none, has them all as its only run.
    """
    weights, counts = _weights(size), np.diff(bounds)
    per = np.where(counts >= size, counts - size + 1, counts > 0)
    out = np.concatenate([[0], np.cumsum(per)])
    runs = words * weights[0]
    for j in range(1, size):
        runs[:-j] += words[j:] * weights[j]
    index = np.repeat(bounds[:-1] - out[:-1], per) + np.arange(out[-1])
    values = runs[index]
    for i in np.flatnonzero((counts > 0) & (counts < size)):
        own = words[bounds[i] : bounds[i + 1]]
        values[out[i]] = np.add.reduce(np.append(own * weights[: len(own)], U(len(own))))
    return mix64(values), out


def distinct(values: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each set sorted and without repeats; `values` is sorted in place."""
    if not len(values):
        return values, bounds
    for low, high in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
        values[low:high].sort()
    keep = np.empty(len(values), bool)
    keep[0] = True
    np.not_equal(values[1:], values[:-1], out=keep[1:])
    firsts = bounds[:-1]
    keep[firsts[firsts < len(values)]] = True
    return values[keep], np.concatenate([[0], np.cumsum(keep)])[bounds]


def set_digests(values: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """128 bits that identify each set."""
    digests = []
    for salt in (U(0x1F83D9ABFB41BD6B), U(0x5BE0CD19137E2179)):
        sums = np.concatenate([np.zeros(1, U), np.cumsum(mix64(values ^ salt))])
        digests.append(mix64(sums[bounds[1:]] - sums[bounds[:-1]] + salt))
    return digests[0], digests[1]


_RANK_BITS = U(40)
_TRACED = 8


def superminhash(values: np.ndarray, bounds: np.ndarray, size: int) -> np.ndarray:
    """SuperMinHash signatures, one row of `size` values per set.

    Each element deals ranks j + r (r in [0, 1)) to the places of a random permutation,
    j = 0, 1, ...; a place keeps the least rank. Rounds run over all sets at once, and a
    set leaves as soon as all its places hold less than the next round can deal. An empty
    set keeps the largest value throughout.
    """
    n = len(bounds) - 1
    signature = np.full((n, size), EMPTY)
    flat = signature.reshape(-1)
    owner = np.repeat(np.arange(n), np.diff(bounds))
    picks: list[np.ndarray] = []
    table = None
    for j in range(size):
        if not len(values):
            break
        x = mix64(values + U((j + 1) * int(GOLDEN) % (1 << 64)))
        pick = ((((x >> _RANK_BITS) * U(size - j)) >> U(24)).astype(np.int64)) + j
        rank = (x & ((U(1) << _RANK_BITS) - U(1))) | (U(j) << _RANK_BITS)
        if j < _TRACED:
            # What stands at `pick` after the exchanges so far, traced back one by one.
            place = pick.copy()
            for i in range(j - 1, -1, -1):
                place = np.where(place == picks[i], i, np.where(place == i, picks[i], place))
            picks.append(pick)
        else:
            rows = np.arange(len(values))
            if table is None:
                table = np.tile(np.arange(size, dtype=np.int16), (len(values), 1))
                for i, p in enumerate(picks):
                    table[rows, i], table[rows, p] = table[rows, p], table[rows, i].copy()
            place = table[rows, pick].astype(np.int64)
            table[rows, pick] = table[:, j]
            table[:, j] = place
        np.minimum.at(flat, owner * size + place, rank)
        running = (signature.max(axis=1) >= (U(j + 1) << _RANK_BITS))[owner]
        if not running.all():
            values, owner = values[running], owner[running]
            picks = [p[running] for p in picks]
            table = None if table is None else table[running]
    return signature


@functools.lru_cache(maxsize=4)
def _probes(size: int) -> np.ndarray:
    """For each place an order of all places in which to look for a value to borrow."""
    draws = mix64(np.arange(1, size * size + 1, dtype=U) * GOLDEN).reshape(size, size)
    return draws.argsort(axis=1)


def one_permutation(values: np.ndarray, bounds: np.ndarray, size: int) -> np.ndarray:
    """MinHash signatures by one permutation, one row of `size` values per set.

    The permuted elements fall into `size` places, each of which keeps its least; an empty
    place borrows from the first one that is not, in an order of its own that is the same
    for all sets. An empty set keeps the largest value throughout.
    """
    n = len(bounds) - 1
    signature = np.full((n, size), EMPTY)
    flat = signature.reshape(-1)
    x = values * GOLDEN
    x ^= x >> U(29)
    x *= U(0xBF58476D1CE4E5B9)
    place = (x >> U(40)) * U(size)
    place >>= U(24)
    place = place.view(np.int64)
    place += np.repeat(np.arange(n) * size, np.diff(bounds))
    x &= U((1 << 40) - 1)
    np.minimum.at(flat, place, x)
    own, probes = flat.copy(), _probes(size)
    empty = np.flatnonzero((flat == EMPTY) & np.repeat(np.diff(bounds) > 0, size))
    at = empty % size
    row = empty - at
    for turn in range(size):
        if not len(empty):
            break
        found = own[row + probes[at, turn]]
        flat[empty] = found
        left = np.flatnonzero(found == EMPTY)
        empty, row, at = empty[left], row[left], at[left]
    return signature


def band_keys(signature: np.ndarray, rows: int) -> np.ndarray:
    """One key per band of `rows` neighbouring signature values."""
    n, size = signature.shape
    bands = signature.reshape(n, size // rows, rows)
    weights = _weights(rows)
    keys = np.zeros(bands.shape[:2], U)
    for j in range(rows):
        keys += mix64(bands[:, :, j]) * weights[j]
    keys += np.arange(size // rows, dtype=U) * GOLDEN
    return mix64(keys).view(np.int64)


def low_bits(signature: np.ndarray) -> np.ndarray:
    """The low four bits of each signature value, sixteen to a long."""
    bits = (signature & U(15)).astype(np.uint8)
    return np.ascontiguousarray(bits[:, ::2] | (bits[:, 1::2] << 4)).view(np.int64)


def estimate(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Similarity of the sets behind rows of low bits (as bytes): the share of equal values,
    less those that are equal by chance."""
    apart = a ^ b
    same = np.count_nonzero(apart & 15 == 0, axis=1) + np.count_nonzero(apart >> 4 == 0, axis=1)
    share = same / (2 * a.shape[1])
    return share - (1 - share) / 15


def lists(values: pa.Array, sizes: np.ndarray) -> pa.Array:
    """List array with `sizes[i]` of the values in row i."""
    return pa.ListArray.from_arrays(
        pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)), values
    )
