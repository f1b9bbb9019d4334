"""Operator 5: toxicity by a support vector machine on a subsequence string kernel.

A document is a bag of words. The kernel of two words is the inner product of their
gap-weighted subsequences of three characters, so an insult with inserted or left-out
characters stays close to the insult. The machine works in the Nyström space of a fixed
number of landmark words. It learns which word of a toxic document is the insult by turns:
pick each toxic document's highest word, train against the words of clean documents, pick
again. A document's score is the calibrated margin of its highest word.

A kernel expansion over landmarks is linear in the subsequences, so scoring a word is a
sum over one table of weights.
"""

from __future__ import annotations

import itertools
import re
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .tables import lean

# Subsequences of three characters within five places; each place beyond three costs DECAY.
SPAN, DECAY = 5, 0.6
LANDMARKS = 128
# Bound of the labelled sample, by class, and of the clean words that one training sees.
SAMPLE_TOXIC, SAMPLE_CLEAN = 1_500, 3_000
CLEAN_WORDS = 20_000
TURNS = 4
# How many times as frequent in toxic documents a word must be to be taken for an insult.
ENRICHED = 5.0
TOXIC_AT = 0.7
WORD_CHARS, WORD_STEP = 32, 24
CACHED = 150_000

_SIZE = 64  # alphabet: 0 none, 1-26 letters, 27-61 all others, 62 start, 63 end
_START, _END = 62, 63
_SPACED = re.compile(r"(?<!\S)\S(?:\s\S){2,}(?!\S)")
_NOISE = re.compile(r"[\W_]+")


def bag_of_words(text: str | None) -> set[str]:
    """The different words of a text, in lower case, and the words that single characters
    between spaces spell."""
    if not text:
        return set()
    text = text.lower()
    words = set(text.split())
    for run in _SPACED.findall(text):
        words.add(re.sub(r"\s", "", run))
    return words


def parts(word: str) -> list[str]:
    """A word without punctuation; a long one as overlapping windows."""
    word = _NOISE.sub("", word)
    if len(word) <= WORD_CHARS:
        return [word]
    return [word[i : i + WORD_CHARS] for i in range(0, len(word) - WORD_CHARS + WORD_STEP, WORD_STEP)]


def _codes(words: list[str]) -> np.ndarray:
    """Alphabet codes of words of one length, with start and end."""
    text = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32)
    letter = (text >= 97) & (text <= 122)
    code = np.where(letter, text.astype(np.int64) - 96, 27 + text % 35).reshape(len(words), -1)
    n = len(words)
    return np.hstack([np.full((n, 1), _START), code, np.full((n, 1), _END)])


def subsequences(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Ids and weights of the subsequences of words of one length, one row per word."""
    codes = _codes(words)
    ids, weights = [], []
    width = codes.shape[1]
    for second, third in itertools.combinations(range(1, SPAN), 2):
        n = width - third
        if n <= 0:
            continue
        first = codes[:, :n] * _SIZE * _SIZE + codes[:, second : second + n] * _SIZE
        ids.append(first + codes[:, third : third + n])
        weights.append(np.full(n, DECAY ** (third - 2)))
    if not ids:
        return np.zeros((len(words), 0), np.int64), np.zeros(0)
    return np.hstack(ids), np.concatenate(weights)


def _norms(ids: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Length of each word's vector: equal subsequences count together."""
    if not ids.size:
        return np.ones(len(ids))
    order = np.argsort(ids, axis=1)
    ids = np.take_along_axis(ids, order, 1)
    new = np.ones(ids.shape, bool)
    new[:, 1:] = ids[:, 1:] != ids[:, :-1]
    starts = np.flatnonzero(new.reshape(-1))
    sums = np.add.reduceat(weights[order].reshape(-1), starts)
    squares = np.bincount(starts // ids.shape[1], sums * sums, len(ids))
    return np.sqrt(squares)


def by_length(words: list[str]) -> Iterator[tuple[np.ndarray, list[str]]]:
    """Places and words of each length, in pieces of bounded size."""
    lengths = np.array([len(w) for w in words])
    for length in np.unique(lengths):
        places = np.flatnonzero(lengths == length)
        for low in range(0, len(places), 1024):
            some = places[low : low + 1024]
            yield some, [words[i] for i in some]


def kernel(words: list[str], landmarks: list[str]) -> np.ndarray:
    """Normalised kernel of each word with each landmark; a few landmarks at a time, to
    bound the memory of their table."""
    out = np.zeros((len(words), len(landmarks)))
    for low in range(0, len(landmarks), 16):
        few = landmarks[low : low + 16]
        table = np.zeros((_SIZE**3, len(few)), np.float32)
        for places, some in by_length(few):
            ids, weights = subsequences(some)
            norms = _norms(ids, weights)
            for row, place in enumerate(places):
                np.add.at(table[:, place], ids[row], weights / norms[row])
        for places, some in by_length(words):
            ids, weights = subsequences(some)
            norms = _norms(ids, weights)
            found = np.zeros((len(some), len(few)))
            for column, weight in zip(ids.T, weights, strict=True):
                found += table[column] * weight
            out[places, low : low + len(few)] = found / norms[:, None]
    return out


@dataclass
class Model:
    """Margin of a word: weighted subsequences over its length, plus a bias. `scale` and
    `shift` turn a document's highest margin into a probability; without `table`, all
    documents have the probability `prior`."""

    table: np.ndarray | None
    bias: float = 0.0
    scale: float = 1.0
    shift: float = 0.0
    prior: float = 0.0

    def margins(self, words: list[str]) -> np.ndarray:
        out = np.full(len(words), self.bias)
        for places, some in by_length(words):
            ids, weights = subsequences(some)
            if ids.size:
                out[places] += (self.table[ids] * weights).sum(1) / _norms(ids, weights)
        return out

    def probability(self, margin: np.ndarray) -> np.ndarray:
        if self.table is None:
            return np.full(len(margin), self.prior)
        return 1 / (1 + np.exp(-np.clip(self.scale * margin + self.shift, -30, 30)))


def _fit_margin(x: np.ndarray, y: np.ndarray, weight: np.ndarray, cost: float = 10.0) -> np.ndarray:
    """Linear support vector machine with squared hinge loss, by Newton steps; the last
    coefficient is the bias."""
    x = np.hstack([x, np.ones((len(x), 1))])
    w = np.zeros(x.shape[1])
    ridge = np.eye(x.shape[1])
    ridge[-1, -1] = 1e-3
    for _ in range(30):
        active = y * (x @ w) < 1
        xa, ya, ca = x[active], y[active], weight[active]
        system = ridge + 2 * cost * (xa.T * ca) @ xa
        new = np.linalg.solve(system, 2 * cost * xa.T @ (ca * ya))
        if np.allclose(new, w, atol=1e-7):
            break
        w = new
    return w


def _fit_probability(margin: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Platt scaling: a logistic curve over margins, with his targets."""
    n_pos, n_neg = int(y.sum()), int((~y).sum())
    target = np.where(y, (n_pos + 1) / (n_pos + 2), 1 / (n_neg + 2))
    x = np.column_stack([margin, np.ones(len(margin))])
    w = np.array([1.0, 0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        system = (x.T * np.maximum(p * (1 - p), 1e-9)) @ x + 1e-3 * np.eye(2)
        step = np.linalg.solve(system, x.T @ (target - p) - 1e-3 * w)
        w = w + np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-6:
            break
    return float(w[0]), float(w[1])


def _grams(word: str, size: int = 4) -> set[str]:
    word = f"^{word}$"
    return {word[i : i + size] for i in range(max(1, len(word) - size + 1))}


def _first_guess(words: list[str], toxic: list[np.ndarray], clean: list[np.ndarray]) -> np.ndarray:
    """For each word the odds of its run of four characters that most toxic and fewest clean
    documents have."""
    index: dict[str, int] = {}
    runs = [[index.setdefault(g, len(index)) for g in _grams(w)] for w in words]
    sizes = np.array([len(r) for r in runs])
    flat = np.fromiter(itertools.chain.from_iterable(runs), np.int32, sizes.sum())
    starts = np.cumsum(sizes) - sizes

    def documents(bags: list[np.ndarray]) -> np.ndarray:
        counts = np.zeros(len(index))
        for bag in bags:
            at = np.repeat(starts[bag] - (np.cumsum(sizes[bag]) - sizes[bag]), sizes[bag])
            counts[np.unique(flat[at + np.arange(len(at))])] += 1
        return counts

    odds = documents(toxic) / (1 + 20 * documents(clean))
    return np.maximum.reduceat(odds[flat], starts)


def _numbered(bags: Iterable[set[str]], index: dict[str, int]) -> list[np.ndarray]:
    """The parts of each bag's words as numbers; bags without any are left out."""
    out = []
    for bag in bags:
        own = {index.setdefault(p, len(index)) for w in bag for p in parts(w) if p}
        if own:
            out.append(np.fromiter(own, np.int32, len(own)))
    return out


def train(toxic: Iterable[set[str]], clean: Iterable[set[str]], landmarks: int = LANDMARKS) -> Model:
    """Model from the bags of words of labelled documents.

    Without toxic or without clean documents that have words, the share of toxic ones is
    every document's score.
    """
    index: dict[str, int] = {}
    toxic_at, clean_at = _numbered(toxic, index), _numbered(clean, index)
    prior = len(toxic_at) / max(1, len(toxic_at) + len(clean_at))
    if not toxic_at or not clean_at:
        return Model(None, prior=prior)
    words = sorted(index)
    number = np.empty(len(words), np.int32)
    for i, word in enumerate(words):
        number[index[word]] = i
    del index
    toxic_at, clean_at = ([np.sort(number[bag]) for bag in bags] for bags in (toxic_at, clean_at))
    in_toxic, in_clean = (np.bincount(np.concatenate(b), minlength=len(words)) for b in (toxic_at, clean_at))
    # An insult is at least so many times as frequent in toxic documents.
    rare = len(clean_at) / len(toxic_at) / ENRICHED
    suspects = [bag[in_clean[bag] <= in_toxic[bag] * rare] for bag in toxic_at]
    suspects = [bag for bag in suspects if len(bag)]
    if not suspects:
        return Model(None, prior=prior)
    clean_words = np.flatnonzero(in_clean)
    sampled = np.random.default_rng(5).permutation(clean_words)[:CLEAN_WORDS]
    guess = _first_guess(words, suspects, clean_at)
    witness = np.array([bag[guess[bag].argmax()] for bag in suspects])
    hard = np.zeros(0, np.int64)
    for _ in range(TURNS):
        positive, counts = np.unique(witness, return_counts=True)
        top = positive[np.argsort(-counts, kind="stable")[: landmarks // 2]]
        basis = [words[i] for i in dict.fromkeys([*top, *sampled[: landmarks - len(top)]])]
        values, vectors = np.linalg.eigh(kernel(basis, basis))
        keep = values > 1e-6 * values[-1]
        project = vectors[:, keep] / np.sqrt(values[keep])
        negative = np.union1d(sampled, hard)
        x = kernel([words[i] for i in [*positive, *negative]], basis) @ project
        y = np.array([1.0] * len(positive) + [-1.0] * len(negative))
        often = np.log1p(in_clean[negative])
        weight = np.concatenate([counts / counts.sum() * 200, often / often.sum() * 200])
        w = _fit_margin(x, y, weight)
        alpha = project @ w[:-1]
        table = np.zeros(_SIZE**3)
        for places, some_words in by_length(basis):
            ids, weights = subsequences(some_words)
            norms = _norms(ids, weights)
            for row, place in enumerate(places):
                np.add.at(table, ids[row], alpha[place] * weights / norms[row])
        model = Model(table, float(w[-1]))
        margin = model.margins(words)
        again = np.array([bag[margin[bag].argmax()] for bag in suspects])
        hard = np.union1d(hard, clean_words[np.argsort(-margin[clean_words], kind="stable")[:2_000]])
        if np.array_equal(again, witness):
            break
        witness = again
    tops = np.array([margin[bag].max() for bag in [*toxic_at, *clean_at]])
    model.scale, model.shift = _fit_probability(tops, np.arange(len(tops)) < len(toxic_at))
    return model


def _held_out(doc_id: Column, folds: int, held: int) -> Column:
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(folds)) == held


def _sampled_ids(labels: DataFrame, toxic: bool) -> DataFrame:
    """Ids of a bounded sample of the documents of one class.

    Rows without a label or an id are not learnt from; of several labels of an id the
    highest counts. The sample has the ids of the least hashes, so that it is the same in
    every run.
    """
    ids = labels.where("doc_id is not null and toxic is not null")
    ids = ids.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    own = ids.where((F.col("toxic") == 1) == F.lit(toxic))
    bound = SAMPLE_TOXIC if toxic else SAMPLE_CLEAN
    share = bound / max(bound, own.count())
    draw = F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000))
    # Half as many again, and a few, are enough to hold the least hashes.
    near = own.where(draw < int(1.5 * share * 1_000_000) + 100)
    return near.orderBy(draw, "doc_id").select("doc_id", F.lit(toxic).alias("toxic")).limit(bound)


def _sampled_texts(docs: DataFrame, chosen: DataFrame) -> DataFrame:
    """`(toxic, doc_id, text)` of the chosen ids; of several texts of an id the least."""
    rows = docs.select("doc_id", F.col("text").cast("string")).join(F.broadcast(chosen), "doc_id")
    return rows.groupBy("toxic", "doc_id").agg(F.min("text").alias("text"))


def labelled_sample(docs: DataFrame, labels: DataFrame, toxic: bool) -> Iterator[set[str]]:
    """Bags of words of a bounded sample of the labelled documents of one class."""
    for row in _sampled_texts(docs, _sampled_ids(labels, toxic)).orderBy("doc_id").toLocalIterator():
        yield bag_of_words(row["text"])


def _score_udf(model) -> Callable[[Column], Column]:
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        fitted: Model = model.value
        known: dict[str, float] = {}
        for texts in batches:
            top = np.full(len(texts), fitted.bias)
            for low in range(0, len(texts) if fitted.table is not None else 0, 256):
                bags = [bag_of_words(t.as_py()) for t in texts[low : low + 256]]
                new = list(set().union(*bags).difference(known))
                if len(known) + len(new) > CACHED:
                    known.clear()
                    new = list(set().union(*bags))
                if new:
                    pieces = [parts(w) for w in new]
                    counts = np.array([len(p) for p in pieces])
                    margin = fitted.margins(list(itertools.chain.from_iterable(pieces)))
                    best = np.maximum.reduceat(margin, np.cumsum(counts) - counts)
                    known.update(zip(new, best.tolist(), strict=True))
                for i, bag in enumerate(bags, low):
                    if bag:
                        top[i] = max(map(known.__getitem__, bag))
            yield pa.array(fitted.probability(top))

    return F.arrow_udf(lean(run), "double")


_MODEL = "table binary, bias double, scale double, shift double, prior double"


def _train_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The model of sampled texts, toxic ones first; only their words are kept."""
    rows = (
        (toxic.as_py(), bag_of_words(text.as_py()))
        for batch in batches
        for toxic, text in zip(batch.column(0), batch.column(1), strict=True)
    )
    held: list[set[str]] = []  # the first clean bag, which ends the toxic ones

    def toxic_bags() -> Iterator[set[str]]:
        for toxic, bag in rows:
            if not toxic:
                held.append(bag)
                return
            yield bag

    def clean_bags() -> Iterator[set[str]]:
        while held:
            yield held.pop()
        for _, bag in rows:
            yield bag

    model = train(toxic_bags(), clean_bags())
    table = None if model.table is None else model.table.tobytes()
    row = {"table": table, "bias": model.bias, "scale": model.scale, "shift": model.shift, "prior": model.prior}
    types = {"table": pa.binary()}
    columns = [pa.array([value], types.get(name, pa.float64())) for name, value in row.items()]
    yield pa.RecordBatch.from_arrays(columns, list(row))


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    """Model of a bounded sample of the labelled documents, trained in a task: the driver
    gets its weights, neither texts nor what training holds in memory."""
    chosen = _sampled_ids(labels, True).unionByName(_sampled_ids(labels, False))
    texts = _sampled_texts(docs, chosen).repartition(1).sortWithinPartitions(F.desc("toxic"), "doc_id")
    row = texts.select("toxic", "text").mapInArrow(lean(_train_rows), _MODEL).first()
    if row is None:  # without any row Spark may leave the task out
        return train([], [])
    table = None if row.table is None else np.frombuffer(row.table)
    return Model(table, row.bias, row.scale, row.shift, row.prior)


def with_toxicity(docs: DataFrame, model: Model, name: str = "score") -> DataFrame:
    """The documents with a column `name`: the probability that the text is toxic.

    Only the text counts. A null text or one without words gets the score of no word.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    return docs.withColumn(name, _score_udf(shared)(F.col("text").cast("string")))


def drop_toxic(docs: DataFrame, labels: DataFrame, *, at: float = TOXIC_AT) -> DataFrame:
    """The documents that score under `at`, with all their columns."""
    name = "score"
    while name in docs.columns:
        name = f"_{name}"
    learn = labels.where(~_held_out(F.col("doc_id"), 3, 1))
    return with_toxicity(docs, fit(docs, learn), name).where(F.col(name) < at).drop(name)
