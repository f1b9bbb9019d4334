"""Operator 12: periodic runs of words, found from minimizers at several scales.

A run is a stretch of consecutive words with smallest period q that is at least
`max(12, 2 q)` words long and that no neighbouring word extends. Periods below
`LEAST_SCALE` are found by comparing all words with those q places on. A larger period
belongs to the scale Q with Q <= q < 2 Q. Windows of Q/2 grams of Q/2 words each span less
than one period, so a run holds each of its windows twice, q places apart, and what is
least in one is least in the other: equal minimizers at distance q seed the run, which is
then extended both ways.

Grams that repeat within half their length lie in stretches of a shorter period. There
only whole stretches are paired: a longer run that spans parts of two of them has as its
period the distance of their starts, or that of their ends, or, where the stretches
touch, any distance that keeps them in step. So the number of seeds stays in proportion
to the number of minimizers and of runs, also in texts of one repeated word.

Texts are taken in blocks, each text between words of its own, so that no Python code runs
per word; one text is handled whole, in memory in proportion to it.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .hashing import GOLDEN, U, chunks, mix64, word_hashes
from .tables import free_names, lean, text_bytes

LEAST_LENGTH = 12
# Least scale of the minimizers; shorter periods are compared directly.
LEAST_SCALE = 16
# An odd number, so powers of it never vanish modulo 2^64.
_BASE = U(0xD1342543DE82EF95)
# Stretches of one period overlap by less than the period, which is at most half a gram, so
# no more of them than this start, or end, within twice the scale.
_NEAR = 8


class Runs(NamedTuple):
    """Runs as arrays: first word, word after the last, smallest period."""

    start: np.ndarray
    end: np.ndarray
    period: np.ndarray


class _Prefix:
    """Polynomial hashes of all stretches of an array of words."""

    def __init__(self, words: np.ndarray):
        n = len(words)
        self.n = n
        self.powers = np.full(n + 1, _BASE)
        self.powers[0] = 1
        np.cumprod(self.powers, out=self.powers)
        self.sums = np.zeros(n + 1, U)
        np.cumsum(words * self.powers[:n], out=self.sums[1:])

    def equal(self, i: np.ndarray, j: np.ndarray, length: np.ndarray) -> np.ndarray:
        """Whether the stretches at i and at j >= i of the given lengths are equal."""
        sums = self.sums
        return (sums[i + length] - sums[i]) * self.powers[j - i] == sums[j + length] - sums[j]

    def grams(self, size: int) -> np.ndarray:
        """A hash of each stretch of `size` words that depends on its words alone."""
        raw = self.sums[size:] - self.sums[:-size]
        # Times the power that lifts all of them to the same place.
        return mix64(raw * self.powers[self.n - size - np.arange(len(raw))])

    def _most(self, fits, limit: np.ndarray) -> np.ndarray:
        """The greatest length up to `limit` that fits, where each shorter one fits too."""
        low = np.zeros(len(limit), np.int64)
        step = 1 << max(int(limit.max(initial=0)).bit_length() - 1, 0)
        while step:
            longer = low + step
            ok = longer <= limit
            ok[ok] = fits(longer, ok)
            low[ok] = longer[ok]
            step >>= 1
        return low

    def stretch(self, at: np.ndarray, lag: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First place and the place after the last to which word `at` equal to word
        `at + lag` extends, that is, the maximal stretch of this lag around the two."""
        right = self._most(
            lambda n, ok: self.equal(at[ok], at[ok] + lag[ok], n[ok]), self.n - at - lag
        )
        left = self._most(lambda n, ok: self.equal(at[ok] - n[ok], at[ok] + lag[ok] - n[ok], n[ok]), at)
        return at - left, at + lag + right


def _short_lags(words: np.ndarray, least: int, below: int) -> Iterator[Runs]:
    """Stretches of each lag below a bound, by comparing each word with that lag on."""
    for lag in range(1, min(below, len(words))):
        same = np.flatnonzero(words[lag:] == words[:-lag])
        if not len(same):
            continue
        cut = np.flatnonzero(np.diff(same) != 1)
        start, last = same[np.append(0, cut + 1)], same[np.append(cut, len(same) - 1)]
        end = last + 1 + lag
        keep = end - start >= max(least, 2 * lag)
        yield Runs(start[keep], end[keep], np.full(int(keep.sum()), lag))


def _minimizers(grams: np.ndarray, window: int) -> np.ndarray:
    """Places of grams that are the least of some `window` (a power of two) neighbours."""

    def spread(values: np.ndarray, pick) -> np.ndarray:
        size = 1
        while size < window:
            values = pick(values[:-size], values[size:])
            size *= 2
        return values

    lows = spread(grams, np.minimum)
    padded = np.concatenate([np.zeros(window - 1, U), lows, np.zeros(window - 1, U)])
    return np.flatnonzero(spread(padded, np.maximum) == grams)


def _seeds(prefix: _Prefix, scale: int) -> tuple[np.ndarray, np.ndarray]:
    """Places and lags in [scale, 2 scale) at which runs of such periods may be found."""
    size = scale // 2
    grams = prefix.grams(size)
    place = _minimizers(grams, scale // 2)
    key = grams[place]
    order = np.argsort(key, kind="stable")
    place, key = place[order], key[order]
    same = key[1:] == key[:-1]
    # A gram alone is of no use.
    used = np.zeros(len(key), bool)
    used[1:] |= same
    used[:-1] |= same
    place, key = place[used], key[used]
    if not len(place):
        return place, place
    _, group = np.unique(key, return_inverse=True)

    # Least distance of neighbours, for grams that repeat within half their length.
    gap = np.full(len(place), np.iinfo(np.int64).max)
    gap[1:] = np.where(group[1:] == group[:-1], place[1:] - place[:-1], gap[1:])
    period = np.full(group[-1] + 1, np.iinfo(np.int64).max)
    np.minimum.at(period, group, gap)
    period = np.where(period <= size // 2, period, 0)[group]

    # Stretches: a gram on its own, or all of the shorter period around it.
    start, end = place.copy(), place + size
    dense = np.flatnonzero(period)
    # Neighbours one period apart lie in one stretch.
    heads = dense[gap[dense] != period[dense]]
    if len(heads):
        first, last = _stretches(prefix, place[heads], period[heads], size)
        at = np.searchsorted(heads, dense, "right") - 1
        start[dense], end[dense] = first[at], last[at]
    fresh = np.ones(len(place), bool)
    fresh[1:] = (group[1:] != group[:-1]) | (start[1:] != start[:-1])
    place, group, period, start, end = (a[fresh] for a in (place, group, period, start, end))

    places, lags = [], []

    def seed(at: np.ndarray, lag: np.ndarray) -> None:
        keep = (lag >= scale) & (lag < 2 * scale) & (at >= 0) & (at + lag < prefix.n)
        places.append(at[keep])
        lags.append(lag[keep])

    for ahead in range(1, min(_NEAR + 1, len(place))):
        i = np.flatnonzero(group[ahead:] == group[:-ahead])
        j = i + ahead
        near = (start[j] - start[i] < 2 * scale) | (end[j] - end[i] < 2 * scale)
        i, j = i[near], j[near]
        seed(start[i], start[j] - start[i])
        seed(end[i] - 1, end[j] - end[i])
    # Stretches that touch: all lags that keep the one in step with the other.
    i = np.flatnonzero((group[1:] == group[:-1]) & (period[1:] > 0) & (start[1:] <= end[:-1]))
    j, step = i + 1, period[i]
    most = np.minimum(start[j] - start[i], end[j] - end[i]) + end[i] - start[j]
    most = np.minimum(most, 2 * scale - 1)
    first = scale + (place[j] - place[i] - scale) % np.maximum(step, 1)
    many = np.maximum((most - first) // np.maximum(step, 1) + 1, 0)
    which = np.repeat(np.arange(len(i)), many)
    turn = np.arange(len(which)) - np.repeat(np.cumsum(many) - many, many)
    lag = first[which] + turn * step[which]
    seed(np.minimum(end[i][which], end[j][which] - lag) - 1, lag)
    return np.concatenate(places), np.concatenate(lags)


def _stretches(
    prefix: _Prefix, place: np.ndarray, period: np.ndarray, size: int
) -> tuple[np.ndarray, np.ndarray]:
    """The maximal stretch of the period around each gram that has it."""
    return prefix.stretch(place, period)


def find_runs(words: np.ndarray, longest: int, least: int = LEAST_LENGTH) -> Runs:
    """All runs of an array of word hashes, by start, then period.

    `longest` bounds the length of a run: that of the longest of several texts which stand
    in `words` one after the other, each followed by a word of its own.
    """
    found = list(_short_lags(words, least, min(LEAST_SCALE, longest // 2 + 1)))
    scale = LEAST_SCALE
    prefix = _Prefix(words) if 2 * scale <= longest else None
    while 2 * scale <= longest:
        place, lag = _seeds(prefix, scale)
        start, end = prefix.stretch(place, lag)
        keep = end - start >= np.maximum(least, 2 * lag)
        found.append(Runs(start[keep], end[keep], lag[keep]))
        scale *= 2
    start, end, period = (np.concatenate(part) for part in zip(*found, strict=True)) if found else (
        np.zeros((3, 0), np.int64)
    )
    # One stretch has several periods only if they are multiples of the smallest one.
    order = np.lexsort((period, end, start))
    start, end, period = start[order], end[order], period[order]
    fresh = np.ones(len(start), bool)
    fresh[1:] = (start[1:] != start[:-1]) | (end[1:] != end[:-1])
    start, end, period = start[fresh], end[fresh], period[fresh]
    order = np.lexsort((period, start))
    return Runs(start[order], end[order], period[order])


def _separated(words: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The words with one of its own after each text, and where each text starts."""
    n = len(bounds) - 1
    own = mix64((np.arange(1, n + 1, dtype=U) + U(1 << 40)) * GOLDEN)
    return np.insert(words, bounds[1:], own), bounds + np.arange(n + 1)


def _kept(text: bytes, start: np.ndarray, end: np.ndarray, period: np.ndarray) -> bytes:
    """The words of a text joined by one space, without those that repeat a run's first
    period."""
    words = text.split()
    if not len(start):
        return b" ".join(words)
    depth = np.zeros(len(words) + 1, np.int64)
    np.add.at(depth, start + period, 1)
    np.add.at(depth, end, -1)
    dropped = np.cumsum(depth[:-1]) > 0
    return b" ".join(w for w, drop in zip(words, dropped.tolist(), strict=True) if not drop)


RUN = ["start", "length", "period"]


def _runs_udf(least: int):
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            rows = iter(texts)
            counts, values, kept = [], [], []
            for data, offsets in chunks(texts):
                hashes, bounds = word_hashes(data, offsets, fold=False)
                words, heads = _separated(hashes, bounds)
                longest = int(np.diff(bounds).max(initial=0))
                # A word that stands apart is never part of a run.
                start, end, period = find_runs(words, longest, least)
                text_of = np.searchsorted(heads, start, "right") - 1
                at = np.searchsorted(text_of, np.arange(len(bounds)))
                start, end = start - heads[text_of], end - heads[text_of]
                for k in range(len(bounds) - 1):
                    own = slice(at[k], at[k + 1])
                    kept.append(_kept(next(rows).as_py() or b"", start[own], end[own], period[own]).decode())
                counts.append(np.diff(at))
                values.append(np.stack([start, end - start, period]))
            sizes = np.concatenate([[0], *counts])
            columns = np.concatenate(values, axis=1) if values else np.zeros((3, 0), np.int64)
            offsets = pa.array(np.cumsum(sizes), pa.int32())
            structs = pa.StructArray.from_arrays([pa.array(c, pa.int64()) for c in columns], RUN)
            lists = pa.ListArray.from_arrays(offsets, structs)
            yield pa.StructArray.from_arrays([lists, pa.array(kept, pa.string())], ["runs", "collapsed"])

    fields = ",".join(f"{name}:long" for name in RUN)
    return F.arrow_udf(lean(run), f"struct<runs:array<struct<{fields}>>,collapsed:string>")


def with_runs(docs: DataFrame, *, least: int = LEAST_LENGTH) -> DataFrame:
    """The rows with `runs`, an array of `start, length, period` by start, then period, and
    `collapsed`, the words joined by one space without those that a run repeats.

    Words are what stands between spaces, tabs, line feeds and the like; they are numbered
    from 0 and compared as they are. A word goes if any run contains it after that run's
    first period. A null or empty text has no words, no runs and an empty `collapsed`. All
    rows stay, repeated ones too; columns of these names are replaced. One narrow step.
    """
    encoded, both = free_names(docs, "encoded", "found_runs")
    rows = docs.drop("runs", "collapsed").withColumn(encoded, text_bytes())
    rows = rows.withColumn(both, _runs_udf(least)(F.col(encoded)))
    return rows.withColumns(
        {"runs": F.col(f"{both}.runs"), "collapsed": F.col(f"{both}.collapsed")}
    ).drop(encoded, both)


def collapse_runs(docs: DataFrame, **options) -> DataFrame:
    """Documents whose runs of a text are cut to one period; other texts stay as they are."""
    (kept,) = free_names(docs, "kept_text")
    found = with_runs(docs.select(F.struct(*docs.columns).alias("row"), "text"), **options)
    text = F.when(F.size("runs") > 0, F.col("collapsed")).otherwise(F.col("text")).alias(kept)
    rows = found.select("row", text)
    return rows.select(*(F.col(kept if c == "text" else f"row.`{c}`").alias(c) for c in docs.columns))


def longest_run(runs: Column) -> Column:
    """The run of greatest length; of equal ones the first, then that of least period."""
    ranked = F.transform(
        runs, lambda r: F.struct((-r["length"]).alias("rank"), r["start"], r["period"], r["length"])
    )
    return F.try_element_at(F.array_sort(ranked), F.lit(1))
