"""Operator 9: language identification by the nearest of several centroids per language.

Texts are vectors of hashed letter n-grams, term frequency (logarithmic) times inverse
document frequency, of length one. Document frequencies are counted over all learnt
documents by Spark; each language's centroids come from spherical k-means over a bounded
sample, one task per language. A text gets the language of its nearest centroid by cosine.
It is rejected where that cosine is lower than that of nearly all learnt documents of the
centroid, and of about the text's length: each centroid has rejection distances of its own.
"""

from __future__ import annotations

import functools
from collections.abc import Callable, Iterator
from dataclasses import dataclass, replace
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from . import hashing
from .tables import lean, materialise

FEATURE_BITS = 16
FEATURES = 1 << FEATURE_BITS
CENTROIDS = 4
# Learnt documents per language from which the centroids are made (the bound of the sample).
SAMPLE = 600
# Rows of a sample (a language and a hash each) up to which it is sent to all tasks.
SMALL_SAMPLE = 100_000
# Share of a centroid's learnt documents that lie beyond its rejection distance.
REJECTED_SHARE = 0.002
# Learnt documents that a distance of its own takes for a centroid's size class, or a centroid;
# a centroid with fewer goes by its language, and a class by whatever is more lenient: the
# centroid, or that class of the language.
ENOUGH = 500
# Few documents say little of their quantile: of this many, a quarter is taken off it, of
# fewer up to a half.
_DOUBT = 100


def lowered(least: float, n: int) -> float:
    """A quantile of `n` cosines, less what it may be off by."""
    return least * (1 - 0.5 * _DOUBT / (n + _DOUBT))


# Classes of texts by the number of their n-grams, each four times as long as the one before.
SIZES = 16
UNKNOWN = "und"


@functools.lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """For each code point its lower-case letter, or a space where it is no letter."""
    table = np.full(0x110000, 32, np.uint32)
    for code in range(0x30000):  # no letters are beyond the third plane
        char = chr(code)
        if char.isalpha():
            low = char.lower()
            table[code] = ord(low) if len(low) == 1 else code
    return table


def _grams(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text index and feature of each 2-gram and 3-gram of letters and word ends, and
    whether each text has a letter."""
    joined = "".join(f"\x00{t or ''}\x00" for t in texts)
    sizes = np.array([len(t or "") + 2 for t in texts])
    codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    letters = _letters()[codes]
    owner = np.repeat(np.arange(len(texts)), sizes)
    is_letter = letters != 32
    has_letter = np.bincount(owner[is_letter], minlength=len(texts)) > 0
    # A space on either side of each word.
    keep = is_letter.copy()
    keep[1:] |= is_letter[:-1]
    keep[:-1] |= is_letter[1:]
    letters, owner = letters[keep].astype(np.uint64), owner[keep]
    if len(letters) < 2:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), has_letter
    one = hashing.mix64(letters)
    two = one[:-1] * hashing.U(3) + one[1:] * hashing.U(5)
    three = two[:-1] * hashing.U(7) + one[2:] * hashing.U(11)
    same2 = owner[:-1] == owner[1:]
    same3 = same2[:-1] & same2[1:]
    gram_owner = np.concatenate([owner[:-1][same2], owner[:-2][same3]])
    values = np.concatenate([two[same2], three[same3]])
    feature = (hashing.mix64(values) >> hashing.U(64 - FEATURE_BITS)).astype(np.int64)
    return gram_owner, feature, has_letter


def _pieces(texts: list[str | None], limit: int = 1 << 20) -> Iterator[list[str | None]]:
    """Runs of whole texts of about `limit` characters, and of at most 256 texts."""
    some, size = [], 0
    for text in texts:
        some.append(text)
        size += len(text or "")
        if size >= limit or len(some) == 256:
            yield some
            some, size = [], 0
    if some:
        yield some


class Vectors(NamedTuple):
    """Sparse rows: entries by row, then feature, and where each row's entries start."""

    feature: np.ndarray
    value: np.ndarray
    bounds: np.ndarray
    has_letter: np.ndarray
    size: np.ndarray  # class by the number of n-grams

    def times(self, columns: np.ndarray) -> np.ndarray:
        """Products with dense vectors, given as one row of `columns` per feature."""
        out = np.zeros((len(self.bounds) - 1, columns.shape[1]))
        filled = np.flatnonzero(np.diff(self.bounds))
        if len(filled):
            parts = columns[self.feature] * self.value[:, None]
            out[filled] = np.add.reduceat(parts, self.bounds[filled], axis=0)
        return out


def vectors(texts: list[str | None], weights: np.ndarray | None = None) -> Vectors:
    """Unit TF-IDF vectors of texts; without weights, plain counts."""
    owner, feature, has_letter = _grams(texts)
    keys, counts = np.unique(owner * FEATURES + feature, return_counts=True)
    owner, feature = keys >> FEATURE_BITS, keys & (FEATURES - 1)
    bounds = np.searchsorted(owner, np.arange(len(texts) + 1))
    value = counts.astype(np.float64)
    total = np.bincount(owner, value, len(texts))
    size = np.minimum(np.log2(np.maximum(total, 1)) // 2, SIZES - 1).astype(np.int64)
    if weights is not None:
        value = np.log1p(value) * weights[feature]
        length = np.sqrt(np.bincount(owner, value * value, len(texts)))
        value = value / length[owner]
    return Vectors(feature, value, bounds, has_letter, size)


def _unit(rows: np.ndarray) -> np.ndarray:
    length = np.linalg.norm(rows, axis=1, keepdims=True)
    return rows / np.where(length > 0, length, 1)


def _document_frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total, n = np.zeros(FEATURES, np.int64), 0
    for batch in batches:
        texts = batch.column(0).to_pylist()
        n += len(texts)
        for some in _pieces(texts):
            total += np.bincount(vectors(some).feature, minlength=FEATURES)
    seen = np.flatnonzero(total)
    feature, counts = np.append(seen, -1), np.append(total[seen], n)
    yield pa.RecordBatch.from_arrays([pa.array(feature), pa.array(counts)], ["feature", "n"])


def spherical_k_means(rows: np.ndarray, k: int, rounds: int = 10) -> np.ndarray:
    """At most `k` unit centroids: farthest-first start, then Lloyd rounds by cosine."""
    centroids = rows[:1]
    while len(centroids) < min(k, len(rows)):
        nearest = (rows @ centroids.T).max(1)
        farthest = int(nearest.argmin())
        if nearest[farthest] > 1 - 1e-6:
            break
        centroids = np.vstack([centroids, rows[farthest]])
    for _ in range(rounds):
        choice = (rows @ centroids.T).argmax(1)
        sums = [rows[choice == c].sum(0) for c in range(len(centroids)) if (choice == c).any()]
        new = _unit(np.vstack(sums))
        if new.shape == centroids.shape and np.allclose(new, centroids, atol=1e-5):
            break
        centroids = new
    return centroids


def _centroids(weights: np.ndarray, k: int) -> Callable[[pd.DataFrame], pd.DataFrame]:
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("draw")
        found = [vectors(some, weights) for some in _pieces(rows["text"].tolist())]
        # Only the features that the sample has; of each, one column.
        used, column = np.unique(np.concatenate([v.feature for v in found]), return_inverse=True)
        lengths = np.concatenate([np.diff(v.bounds) for v in found])
        dense = np.zeros((len(lengths), len(used)), np.float32)
        dense[np.repeat(np.arange(len(lengths)), lengths), column] = np.concatenate([v.value for v in found])
        dense = dense[np.concatenate([v.has_letter for v in found])]
        if not len(dense):
            return pd.DataFrame({"lang": [], "centroid": []})
        centroids = np.zeros((0, FEATURES), "<f4")
        for c in spherical_k_means(dense, k):
            row = np.zeros((1, FEATURES), "<f4")
            row[0, used] = c
            centroids = np.vstack([centroids, row])
        data = {"lang": rows["lang"].iloc[0], "centroid": [c.tobytes() for c in centroids]}
        return pd.DataFrame(data)

    return run


@dataclass
class Model:
    weights: np.ndarray
    languages: list[str]  # of each centroid
    centroids: np.ndarray  # a column per centroid
    distances: np.ndarray  # least cosine that is not rejected, per centroid and size class

    def nearest(self, found: Vectors) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Nearest centroid of each vector (-1 without a letter), its cosine, and whether it is
        rejected."""
        if not self.languages:
            n = len(found.has_letter)
            return np.full(n, -1), np.zeros(n), np.ones(n, bool)
        cosine = found.times(self.centroids)
        best = cosine.argmax(1)
        score = np.clip(np.where(found.has_letter, cosine.max(1), 0.0), 0.0, 1.0)
        rejected = ~found.has_letter | (score < self.distances[best, found.size])
        return np.where(found.has_letter, best, -1), score, rejected


def _sample(learn: DataFrame, sample: int) -> DataFrame:
    """`lang, text, draw` of at most `sample` documents a language, those of the least draws.

    Draws are hashes, so a share of them that holds about three times the sample is cut off
    first, and no task sorts all documents of a language.
    """
    draws = learn.select("lang", "draw").distinct()
    share = draws.groupBy("lang").agg((F.lit(3.0 * sample) / F.count("*")).alias("share"))
    low = (F.col("draw").cast("double") / 2.0**64 + 0.5) <= F.col("share")
    place = F.row_number().over(Window.partitionBy("lang").orderBy("draw"))
    chosen = draws.join(share, "lang").where(low).withColumn("place", place).where(F.col("place") <= sample)
    chosen = materialise(chosen.select("lang", "draw"), "language-sample")
    if chosen.count() <= SMALL_SAMPLE:
        chosen = F.broadcast(chosen)
    # Repeated rows have the same draw, and count once.
    return learn.join(chosen, ["lang", "draw"]).groupBy("lang", "draw").agg(F.first("text").alias("text"))


def _distances(learn: DataFrame, model: Model) -> np.ndarray:
    """Least cosine that is not rejected, per centroid and size class: a low quantile over all
    learnt documents that fall to a centroid of their own language."""
    shared = learn.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = np.array(shared.value.languages, object)
        for batch in batches:
            langs, texts = np.array(batch.column(0).to_pylist(), object), batch.column(1).to_pylist()
            low = 0
            for some in _pieces(texts):
                rows = vectors(some, shared.value.weights)
                (best, score, _), size = shared.value.nearest(rows), rows.size
                own = (best >= 0) & (names[best] == langs[low : low + len(some)])
                low += len(some)
                arrays = [pa.array(best[own]), pa.array(size[own]), pa.array(score[own])]
                yield pa.RecordBatch.from_arrays(arrays, ["centroid", "size", "score"])

    scores = learn.select("lang", "text").mapInArrow(lean(run), "centroid long, size long, score double")
    names = model.languages
    lang = F.get(F.array(*map(F.lit, names)), F.col("centroid").cast("int")).alias("lang")
    quantile = F.percentile_approx("score", REJECTED_SHARE, 10_000).alias("least")
    counted = scores.cube(lang, "centroid", "size").agg(F.count("*").alias("n"), quantile)
    # A fixed number of classes for each centroid.
    rows = [(r.lang, r.centroid, r["size"], r.n, lowered(r.least, r.n)) for r in counted.collect() if r.n]
    found = {row[:3]: row[3:] for row in rows}

    def distance(centroid: int, size: int) -> float:
        lang = names[centroid]
        n, least = found.get((lang, centroid, size), (0, 0.0))
        if n >= ENOUGH:
            return least
        n, least = found.get((lang, centroid, None), (0, 0.0))
        if n < ENOUGH:
            _, least = found.get((lang, None, None), (0, 0.0))
        return min(least, found.get((lang, None, size), (0, least))[1])

    return np.array([[distance(c, size) for size in range(SIZES)] for c in range(len(names))])


def fit(docs: DataFrame, *, centroids: int = CENTROIDS, sample: int = SAMPLE) -> Model:
    """Model from `text` and `lang`; rows without either, or with the label for unknown, teach nothing."""
    draw = F.xxhash64("doc_id", "text").alias("draw")
    learn = docs.select(F.col("text").cast("string"), F.col("lang").cast("string"), draw)
    learn = learn.where(F.col("text").isNotNull() & F.col("lang").isNotNull() & (F.col("lang") != UNKNOWN))
    counted = learn.select("text").mapInArrow(lean(_document_frequencies), "feature long, n long")
    counts = dict(counted.groupBy("feature").agg(F.sum("n")).collect())  # a fixed number of rows
    n = counts.pop(-1, 0)
    frequency = np.array([counts.get(f, 0) for f in range(FEATURES)], float)
    weights = np.log((1 + n) / (1 + frequency)) + 1
    made = _centroids(weights, centroids)
    found = _sample(learn, sample).groupBy("lang").applyInPandas(made, "lang string, centroid binary")
    rows = sorted((r["lang"], bytes(r["centroid"])) for r in found.collect())
    stacked = np.array([np.frombuffer(c, "<f4") for _, c in rows]).reshape(len(rows), FEATURES)
    names = [lang for lang, _ in rows]
    model = Model(weights, names, np.ascontiguousarray(stacked.T), np.zeros((len(rows), SIZES)))
    return replace(model, distances=_distances(learn, model)) if rows else model


_FOUND = "struct<lang:string,score:double,rejected:boolean>"


def _predict_udf(model) -> Callable[[Column], Column]:
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        names = np.array([*model.value.languages, UNKNOWN], object)  # the last one is number -1
        for texts in batches:
            weights = model.value.weights
            parts = [model.value.nearest(vectors(some, weights)) for some in _pieces(texts.to_pylist())]
            best, score, rejected = (
                np.concatenate(c) for c in zip((np.zeros(0, int), np.zeros(0), np.zeros(0, bool)), *parts, strict=True)
            )
            yield pa.StructArray.from_arrays(
                [pa.array(names[best], pa.string()), pa.array(score, pa.float64()), pa.array(rejected)],
                ["lang", "score", "rejected"],
            )

    return F.arrow_udf(lean(run), _FOUND)


def with_language(docs: DataFrame, model: Model, *, name: str = "language") -> DataFrame:
    """The documents with a column `name`: nearest language, its cosine, and whether it is rejected.

    Only the text counts. A null text or one without letters is unknown with score 0 and
    rejected; so is every text where nothing was learnt.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    return docs.withColumn(name, _predict_udf(shared)(F.col("text").cast("string")))
