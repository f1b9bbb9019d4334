"""Signatures against scalar versions, and components against union-find."""

from __future__ import annotations

import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from sparktape.llm import hashing, line_dedup, linking, near_dedup
from sparktape.llm.linking import _members, bucket_members, connected

MASK = (1 << 64) - 1


def mix(x: int) -> int:
    x ^= x >> 30
    x = x * 0xBF58476D1CE4E5B9 & MASK
    x ^= x >> 27
    x = x * 0x94D049BB133111EB & MASK
    return x ^ x >> 31


def scalar_superminhash(elements: list[int], size: int) -> list[int]:
    """One element after the other, each with its own permutation, all rounds."""
    out = [MASK] * size
    for element in elements:
        place = list(range(size))
        for j in range(size):
            x = mix((element + (j + 1) * int(hashing.GOLDEN)) & MASK)
            k = j + ((x >> 40) * (size - j) >> 24)
            place[j], place[k] = place[k], place[j]
            out[place[j]] = min(out[place[j]], (x & (1 << 40) - 1) | j << 40)
    return out


@pytest.mark.parametrize("size", [4, 16, 48])
def test_superminhash_equals_scalar(size):
    rng = random.Random(size)
    sets = [[rng.getrandbits(64) for _ in range(n)] for n in (0, 1, 2, 7, 40, 300)]
    bounds = np.cumsum([0, *map(len, sets)])
    values = np.array([v for s in sets for v in s], np.uint64)
    found = hashing.superminhash(values, bounds, size)
    assert [row.tolist() for row in found] == [scalar_superminhash(s, size) for s in sets]


@pytest.mark.parametrize("signature", [hashing.superminhash, hashing.one_permutation])
def test_share_of_equal_values_is_the_similarity(signature):
    rng = np.random.default_rng(3)
    shared, own = rng.integers(0, 1 << 63, 800), rng.integers(0, 1 << 63, (2, 100))
    sets = [np.concatenate([shared, o]).astype(np.uint64) for o in own]
    found = signature(np.concatenate(sets), np.array([0, 900, 1800]), 384)
    assert np.mean(found[0] == found[1]) == pytest.approx(0.8, abs=0.07)
    low = hashing.low_bits(found).view(np.uint8)
    assert hashing.estimate(low[:1], low[1:])[0] == pytest.approx(0.8, abs=0.08)


def test_words_and_shingles_equal_plain_python():
    texts = ["", "  ", "One", "one two", "a b\tc\nd e", "É é\x0bX y\rz  q", "w " * 50, "日本 語"]
    values = pa.array([t.encode() for t in texts] + [None], pa.binary())
    (data, offsets), *rest = hashing.chunks(values)
    assert not rest
    words, bounds = hashing.word_hashes(data, offsets)
    plain = [t.encode().lower().split() for t in texts] + [[]]
    assert np.diff(bounds).tolist() == [len(p) for p in plain]
    seen: dict[bytes, int] = {}
    for word, value in zip((w for p in plain for w in p), words.tolist(), strict=True):
        assert seen.setdefault(word, value) == value
    assert len(set(seen.values())) == len(seen)
    runs, starts = hashing.distinct(*hashing.shingles(words, bounds, 3))
    wanted = [{tuple(p[i : i + 3]) for i in range(max(1, len(p) - 2))} if p else set() for p in plain]
    assert np.diff(starts).tolist() == [len(w) for w in wanted]


def test_connected_equals_union_find(spark):
    rng = random.Random(8)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(170)]
    links += [(1000 + i, 1001 + i) for i in range(60)]  # a long chain
    links += [(2000, 2001 + i) for i in range(200)]  # a hub
    links += links[:50] + [(7, 7)]
    parent: dict[int, int] = {}

    def find(x: int) -> int:
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in links:
        low, high = sorted((find(a), find(b)))
        parent[high] = low
    found = connected(spark.createDataFrame(links, "a long, b long")).collect()
    wanted = {x: find(x) for x in parent if find(x) != x}
    assert {r.node: r.root for r in found} == wanted


def test_no_links(spark):
    assert connected(spark.createDataFrame([], "a long, b long")).isEmpty()


def test_buckets_across_batches_and_tasks(spark):
    rows = [(k, 100 * k + i) for k in range(40) for i in range([1, 2, 5, 90][k % 4])]
    found = bucket_members(spark.createDataFrame(rows, "key long, node long").repartition(7))
    got = sorted((r.key, r.node, r.n) for r in found.collect())
    assert got == sorted((k, n, [1, 2, 5, 90][k % 4]) for k, n in rows if k % 4)
    batch = pa.RecordBatch.from_pydict({"key": [1, 1, 2, 3, 3], "node": [1, 2, 3, 4, 5]})
    pieces = [batch.slice(i, 1) for i in range(5)]
    for batches in ([batch], pieces, [batch.slice(0, 1), batch.slice(1, 3), batch.slice(4)]):
        out = [r for b in _members(iter(batches)) for r in b.to_pylist()]
        assert sorted((r["key"], r["node"]) for r in out if not r["edge"]) == [(1, 1), (1, 2), (3, 4), (3, 5)]
        assert sorted((r["key"], r["alone"]) for r in out if r["edge"]) == [(1, False), (3, False)]


def test_band_keys_are_shuffled_in_blocks(spark, monkeypatch):
    """Many keys to a row, and of a key that many nodes have no more than two nodes a block."""
    rng = np.random.default_rng(8)
    key, node = rng.integers(-(2**63), 2**63 - 1, (2, 30_000))
    key[::3], key[1::1000] = 7, key[2::1000]
    blocks = pa.Table.from_batches(
        list(linking._key_blocks(64)(iter([pa.RecordBatch.from_pydict({"key": key, "node": node})])))
    ).to_pylist()
    assert len(blocks) <= 64 + 3
    sent = [(k, n, b["sure"]) for b in blocks for k, n in zip(b["key"], b["node"], strict=True)]
    assert sorted(s[:2] for s in sent) == sorted(zip(key.tolist(), node.tolist(), strict=True))
    assert sum(k == 7 and not sure for k, _, sure in sent) == 2 and all(k == 7 for k, _, sure in sent if sure)

    monkeypatch.setattr(linking, "KEYS_AT_ONCE", 50)
    rows = [(i, [i % 2, 100 + i // 3, 1000 + i, -(2**60) * (i % 7)]) for i in range(200)] + [(500, []), (501, None)]
    found = bucket_members(spark.createDataFrame(rows, "node long, key array<long>").repartition(5))
    flat = [(k, n) for n, keys in rows for k in keys or []]
    count = Counter(k for k, _ in flat)
    assert sorted(map(tuple, found.collect())) == sorted((k, n, count[k]) for k, n in flat if count[k] > 1)


def pairs_at_threshold(n: int, k: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """`n` pairs of sets of 9k values, with 8k of 10k in common."""
    values = np.random.default_rng(seed).integers(0, 2**63, (n, 10 * k), dtype=np.uint64)
    sets = np.empty((2 * n, 9 * k), np.uint64)
    sets[0::2], sets[1::2] = values[:, : 9 * k], np.concatenate([values[:, : 8 * k], values[:, 9 * k :]], 1)
    return sets.reshape(-1), np.arange(2 * n + 1) * (9 * k)


def missed(signature: np.ndarray, bands: int, rows: int, floor: float) -> float:
    keys = hashing.band_keys(signature[:, : bands * rows], rows)
    low = hashing.low_bits(signature).view(np.uint8)
    found = (keys[0::2] == keys[1::2]).any(1) & (hashing.estimate(low[0::2], low[1::2]) >= floor)
    return 1 - found.mean()


@pytest.mark.parametrize("k", [2, 6, 12, 50])
def test_lines_missed_at_the_threshold(k):
    signatures = [hashing.one_permutation(*pairs_at_threshold(10_000, k, s), line_dedup.VALUES) for s in range(2)]
    assert missed(np.concatenate(signatures), line_dedup.BANDS, line_dedup.ROWS, line_dedup.SKETCH_FLOOR) < 0.0035


def test_documents_missed_at_the_threshold():
    size = near_dedup.BANDS * near_dedup.ROWS
    signatures = [hashing.superminhash(*pairs_at_threshold(1_000, 120, s), size) for s in range(8)]
    assert missed(np.concatenate(signatures), near_dedup.BANDS, near_dedup.ROWS, near_dedup.SKETCH_FLOOR) < 0.0005
