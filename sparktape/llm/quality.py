"""Operator 10: quality rules on counts, repeats and n-gram perplexity.

A byte 5-gram model with modified Kneser-Ney smoothing per language, over whole texts: their
words joined by single spaces, so that n-grams run across words. Spark counts the n-grams of
all documents, takes continuation counts and discounts from them, and joins the interpolated
probabilities level by level. The probabilities of the longest n-grams, of which the documents
hold no unseen ones, become sorted arrays of hashes, one to one within a language, in blocks
of bounded size; texts are scored against one block after the other. Each language rejects
documents outside a band of perplexity.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import hashing
from .tables import in_filter, key_filter, lean, materialise, text_bytes

ORDER = 5
# N-grams of a block of the model (12 bytes each), which is sent to all tasks. A larger model
# has several blocks, and texts are read once for each.
BLOCK_GRAMS = 1 << 22
# Distinct n-grams that a task holds before it passes their counts on.
HELD_GRAMS = 1 << 22
# Near copies of a text that one task joins; a larger group is dealt to several.
GROUP_ROWS = 1_000
# Spread of a language's log perplexity (quartile distance) allowed beyond its quartiles.
BAND_SPREADS = 6.0
# Quartile distance of a normal distribution in standard deviations.
_NORMAL_SPREAD = 1.349
# Languages up to which their discounts are sent to all tasks.
FEW_LANGUAGES = 100_000
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
_START, _END = 2, 3
_SYMBOLS = np.isin(np.arange(256), np.frombuffer(b"#*$%&|<>", np.uint8))

# -- the rules on counts --------------------------------------------------------------------

_BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def _repeated_words(words: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Words of each text that are in a run of three found twice or more in it."""
    runs, starts = hashing.shingles(words, bounds, 3)
    out = np.zeros(len(bounds) - 1, np.int64)
    for i, (low, high) in enumerate(zip(starts[:-1].tolist(), starts[1:].tolist(), strict=True)):
        if high - low < 2:
            continue
        own = runs[low:high]
        order = np.argsort(own)
        same = own[order[1:]] == own[order[:-1]]
        twice = np.zeros(len(own), bool)
        twice[order[1:][same]] = True
        twice[order[:-1][same]] = True
        covered = np.zeros(len(own) + 2, bool)
        for shift in range(3):
            covered[shift : shift + len(own)] |= twice
        out[i] = np.count_nonzero(covered)
    return out


def _duplicate_lines(text: bytes) -> int:
    seen: set[bytes] = set()
    count = 0
    for line in text.split(b"\n"):
        if line in seen:
            count += 1
        elif line.strip():
            seen.add(line)
    return count


def base_counts(texts: pa.Array) -> dict[str, np.ndarray]:
    """The counts that the rules look at, for texts as bytes; a null text has none."""
    found: dict[str, list[np.ndarray]] = {name: [np.zeros(0, np.int64)] for name in _BASE}
    for data, offsets in hashing.chunks(texts):
        words, bounds = hashing.word_hashes(data, offsets, fold=False)
        found["n_words"].append(np.diff(bounds))
        # A code point is a byte that does not continue one.
        chars = np.concatenate([[0], np.cumsum(((data & 0xC0) != 0x80) & ~hashing.IS_SPACE[data])])
        found["word_chars"].append(chars[offsets[1:]] - chars[offsets[:-1]])
        symbols = np.concatenate([[0], np.cumsum(_SYMBOLS[data])])
        found["n_symbols"].append(symbols[offsets[1:]] - symbols[offsets[:-1]])
        raw = data.tobytes()
        spans = zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)
        found["n_dup_lines"].append(np.array([_duplicate_lines(raw[a:b]) for a, b in spans], np.int64))
        found["n_repeat_words"].append(_repeated_words(words, bounds))
    return {name: np.concatenate(parts).astype(np.int64) for name, parts in found.items()}


# -- copies and near copies ---------------------------------------------------------------------


def sketches(texts: pa.Array) -> np.ndarray:
    """A number per text that copies share, and near copies mostly: a hash of the two least
    of its three-word shingles, under two orders. Texts without words share one."""
    out = []
    for data, offsets in hashing.chunks(texts):
        runs, bounds = hashing.shingles(*hashing.word_hashes(data, offsets, fold=False), 3)
        filled = np.flatnonzero(np.diff(bounds))
        found = np.zeros(len(offsets) - 1, np.uint64)
        if len(filled):
            first = np.minimum.reduceat(runs, bounds[filled])
            second = np.minimum.reduceat(hashing.mix64(runs ^ hashing.GOLDEN), bounds[filled])
            found[filled] = hashing.mix64(first * hashing.U(3) + second)
        out.append(found)
    return np.concatenate([np.zeros(0, np.uint64), *out]).view(np.int64)


def _same(batch: pa.RecordBatch) -> np.ndarray:
    """For each row of `lang, text` a key that copies and near copies in a language share."""
    coded = batch.column("lang").dictionary_encode()
    salts = np.array([_salt(name) for name in coded.dictionary.to_pylist()], np.uint64)
    found = sketches(batch.column("text")).view(np.uint64)
    return hashing.mix64(found * hashing.GOLDEN + salts[coded.indices.to_numpy()]).view(np.int64)


# -- counting and smoothing ------------------------------------------------------------------


def text_grams(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The 5-grams of texts (words joined by one space, start symbols before, an end after
    them) as their bytes in one number, and how many each text has: none without words."""
    pad, end = bytes([_START]) * (ORDER - 1), bytes([_END])
    bodies = [b" ".join(text.split()) for text in texts]
    parts = [pad + body + end if body else b"" for body in bodies]
    sizes = np.array([len(p) for p in parts], np.int64)
    per = np.maximum(sizes - (ORDER - 1), 0)
    data = np.frombuffer(b"".join(parts), np.uint8).astype(np.int64)
    if not len(data):
        return np.zeros(0, np.int64), per
    keys = np.zeros(len(data) - ORDER + 1, np.int64)
    for j in range(ORDER):
        keys = (keys << 8) | data[j : len(keys) + j]
    starts = np.cumsum(sizes) - sizes
    return keys[np.repeat(starts - (np.cumsum(per) - per), per) + np.arange(per.sum())], per


def _runs(langs: list[str], texts: list[bytes | None]) -> Iterator[tuple[str, list[int], list[bytes]]]:
    """Texts of one language at a time, about `CHUNK_BYTES` of them: their places and bytes."""
    held: dict[str, tuple[list[int], list[bytes], int]] = {}
    for place, (lang, text) in enumerate(zip(langs, texts, strict=True)):
        places, some, size = held.get(lang, ([], [], 0))
        places.append(place)
        some.append(text or b"")
        size += len(text or b"")
        if size >= hashing.CHUNK_BYTES:
            yield lang, places, some
            held.pop(lang, None)
        else:
            held[lang] = places, some, size
    for lang, (places, some, _) in held.items():
        yield lang, places, some


def _added(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    found, inverse = np.unique(np.concatenate(keys), return_inverse=True)
    return found, np.bincount(inverse, np.concatenate(counts), len(found)).astype(np.int64)


def _count_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    tables: dict[str, tuple[np.ndarray, np.ndarray]] = {}

    def flush() -> Iterator[pa.RecordBatch]:
        for lang, (keys, counts) in tables.items():
            for low in range(0, len(keys), 1 << 18):
                some = slice(low, low + (1 << 18))
                arrays = [pa.array([lang] * len(keys[some]), pa.string()), pa.array(keys[some]), pa.array(counts[some])]
                yield pa.RecordBatch.from_arrays(arrays, ["lang", "gram", "n"])
        tables.clear()

    for batch in batches:
        for lang, _, texts in _runs(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            keys, counts = np.unique(text_grams(texts)[0], return_counts=True)
            if lang in tables:
                keys, counts = _added([tables[lang][0], keys], [tables[lang][1], counts])
            tables[lang] = keys, counts
            if sum(len(k) for k, _ in tables.values()) > HELD_GRAMS:
                yield from flush()
    yield from flush()


def _language() -> Column:
    """A name for the language's own model; null has one too."""
    return F.coalesce(F.concat(F.lit("="), F.col("lang").cast("string")), F.lit(""))


def _most(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    keys, counts = np.concatenate(keys), np.concatenate(counts)
    order = np.argsort(keys, kind="stable")
    found, starts = np.unique(keys[order], return_index=True)
    return found, np.maximum.reduceat(counts[order], starts) if len(starts) else counts


def _count_joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """`lang, same, gram, n` from rows `lang, same, part, split, text` in order of the first
    three: each n-gram as often as in the text of the group that has most of it. Groups that
    are whole are added up, and have no `same`; of split ones each part comes for itself."""
    group, keys, counts, held = None, [], [], 0
    done: dict[str, tuple[np.ndarray, np.ndarray]] = {}

    def rows(lang: str, same: int | None, grams: np.ndarray, n: np.ndarray) -> Iterator[pa.RecordBatch]:
        for low in range(0, len(grams), 1 << 18):
            some = slice(low, low + (1 << 18))
            size = len(grams[some])
            arrays = [pa.array([lang] * size, pa.string()), pa.array([same] * size, pa.int64()), pa.array(grams[some]), pa.array(n[some])]
            yield pa.RecordBatch.from_arrays(arrays, ["lang", "same", "gram", "n"])

    def flush() -> Iterator[pa.RecordBatch]:
        for lang, found in done.items():
            yield from rows(lang, None, *found)
        done.clear()

    def end() -> Iterator[pa.RecordBatch]:
        if not keys:
            return
        lang, same, _, split = group
        found = _most(keys, counts)
        if split:
            yield from rows(lang, same, *found)
            return
        before = done.get(lang)
        done[lang] = _added([before[0], found[0]], [before[1], found[1]]) if before else found
        if sum(len(k) for k, _ in done.values()) > HELD_GRAMS:
            yield from flush()

    for batch in batches:
        for *key, text in zip(*(batch.column(i).to_pylist() for i in range(5)), strict=True):
            if key != group:
                yield from end()
                group, keys, counts, held = key, [], [], 0
            grams, n = np.unique(text_grams([text])[0], return_counts=True)
            keys.append(grams)
            counts.append(n)
            held += len(grams)
            if held > max(HELD_GRAMS // 4, 2 * len(keys[0])):
                found = _most(keys, counts)
                keys, counts, held = [found[0]], [found[1]], len(found[0])
    yield from end()
    yield from flush()


def gram_counts(docs: DataFrame) -> DataFrame:
    """`lang, gram, n`: how often each 5-gram occurs, over all different texts.

    Copies count once. Of near copies (texts of one sketch) every text is counted, and what
    they share once: an n-gram as often as in the one of them that has most of it. So a text
    that a third of the rows hold weighs no more than any other, and is not made likely by
    its copies, and no text is left out for being like another.

    Rows that may have a copy, by a filter of fixed size over sketches, are brought together
    first, one of each copy in every task before the shuffle, and large groups in parts; all
    others are counted where they are.
    """
    rows = docs.select(_language().alias("lang"), text_bytes().alias("text")).where("length(text) > 0")

    def keys_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array(_same(batch))], ["same"])

    counts = rows.mapInArrow(lean(keys_of), "same long").groupBy("same").agg(F.count("*").alias("n"))
    groups = materialise(counts.where("n > 1"), "quality-groups")
    bits = key_filter(groups, F.col("same"))

    def single(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        alone = (batch.filter(pa.array(~in_filter(bits.value, _same(batch)))) for batch in batches)
        yield from _count_grams(alone)

    def copied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            same = _same(batch)
            held = np.flatnonzero(in_filter(bits.value, same))
            yield batch.take(pa.array(held)).append_column("same", pa.array(same[held]))

    kind = "lang string, gram long, n long"
    texts = rows.mapInArrow(lean(copied), "lang string, text binary, same long").distinct()
    # At most one row for every `GROUP_ROWS` documents.
    large = groups.where(F.col("n") > GROUP_ROWS).select("same", F.ceil(F.col("n") / GROUP_ROWS).alias("parts"))
    part = F.coalesce(F.pmod(F.xxhash64("text"), F.col("parts")), F.lit(0).cast("long")).alias("part")
    texts = texts.join(F.broadcast(large), "same", "left").select(
        "lang", "same", part, F.col("parts").isNotNull().alias("split"), "text"
    )
    texts = texts.repartition("lang", "same", "part").sortWithinPartitions("lang", "same", "part")
    joined = texts.mapInArrow(lean(_count_joined), "lang string, same long, gram long, n long")
    joined = joined.groupBy("lang", "same", "gram").agg(F.sum("n").alias("added"), F.max("n").alias("most"))
    joined = joined.select("lang", "gram", F.when(F.col("same").isNull(), F.col("added")).otherwise(F.col("most")).alias("n"))
    counted = rows.mapInArrow(lean(single), kind).unionByName(joined)
    return counted.groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def _discounts(level: DataFrame) -> DataFrame:
    """Per language the discounts of counts 1, 2 and 3 or more, from counts of counts."""
    n = [F.sum((F.col("n") == i).cast("double")) for i in range(1, 5)]
    counted = level.groupBy("lang").agg(*[c.alias(f"n{i}") for i, c in enumerate(n, 1)])
    y = F.try_divide(F.col("n1"), F.col("n1") + 2 * F.col("n2"))

    def discount(i: int) -> Column:
        d = i - (i + 1) * y * F.try_divide(F.col(f"n{i + 1}"), F.col(f"n{i}"))
        return F.least(F.greatest(F.coalesce(d, F.lit(0.5)), F.lit(0.05)), F.lit(i - 0.05))

    found = counted.select("lang", *[discount(i).alias(f"d{i}") for i in (1, 2, 3)])
    found = materialise(found, "discounts")
    # A row per language. Sent to all tasks, so that no task gets a whole language.
    return F.broadcast(found) if found.count() <= FEW_LANGUAGES else found


def kneser_ney(counts: DataFrame) -> DataFrame:
    """`lang, gram, value`: the interpolated probability of the last byte of each seen 5-gram
    after the four before it.

    The model has counted the very documents that it scores, and would find any junk likely
    that it has seen once. So, as in leaving-one-out estimation, an n-gram seen once counts
    as unseen: it gets what is left for such ones, at every order.
    """
    levels = [counts]
    for order in range(ORDER - 1, 0, -1):
        # Continuations: in how many different contexts one byte longer the n-gram is seen.
        suffix = F.col("gram").bitwiseAND((1 << (8 * order)) - 1).alias("gram")
        levels.append(levels[-1].groupBy("lang", suffix).agg(F.count("*").alias("n")))
    below = None
    for order, level in enumerate(reversed(levels), 1):
        level = level.join(_discounts(level), "lang")
        taken = F.when(F.col("n") == 1, F.col("d1")).when(F.col("n") == 2, F.col("d2")).otherwise(F.col("d3"))
        level = level.select(
            "lang", "gram", F.shiftright("gram", 8).alias("context"), "n", taken.alias("taken")
        )
        contexts = level.groupBy("lang", "context").agg(
            F.sum("n").alias("total"), F.sum("taken").alias("left")
        )
        contexts = contexts.withColumn("gamma", F.col("left") / F.col("total"))
        level = level.join(contexts, ["lang", "context"])
        # Left out of its own model, a document would find what was seen once unseen.
        own = F.when(F.col("n") > 1, (F.col("n") - F.col("taken")) / F.col("total")).otherwise(0.0)
        if below is None:
            p = own + F.col("gamma") / 256
        else:
            level = level.withColumn("lower", F.col("gram").bitwiseAND((1 << (8 * (order - 1))) - 1))
            smaller = below.select("lang", F.col("gram").alias("lower"), F.col("value").alias("p_lower"))
            level = level.join(smaller, ["lang", "lower"])
            p = own + F.col("gamma") * F.col("p_lower")
        below = materialise(level.select("lang", "gram", p.alias("value")), "kneser-ney")
    return below


# -- the model in sorted hash arrays ------------------------------------------------------------


@functools.lru_cache(maxsize=1024)
def _salt(lang: str) -> np.uint64:
    return np.frombuffer(hashlib.blake2b(lang.encode(), digest_size=8).digest(), np.uint64)[0]


def gram_keys(lang: str, grams: np.ndarray) -> np.ndarray:
    """64-bit hashes of n-grams of a language, all different; those of different languages
    meet by chance only."""
    return hashing.mix64(grams.view(np.uint64) * hashing.GOLDEN + _salt(lang)).view(np.int64)


def _key_udf() -> Callable[[Column, Column], Column]:
    def run(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for langs, grams in batches:
            coded = langs.dictionary_encode()
            names, which = coded.dictionary.to_pylist(), coded.indices.to_numpy()
            keys, out = grams.to_numpy(), np.zeros(len(grams), np.int64)
            for i, name in enumerate(names):
                own = which == i
                out[own] = gram_keys(name, keys[own])
            yield pa.array(out)

    return F.arrow_udf(run, "long")


def fit(docs: DataFrame) -> DataFrame:
    """`key, value`: hash and log probability of every 5-gram of every language."""
    model = kneser_ney(materialise(gram_counts(docs), "gram-counts"))
    key = _key_udf()(F.col("lang"), F.col("gram")).alias("key")
    return materialise(model.select(key, F.log("value").cast("float").alias("value")), "quality-model")


class Block:
    """Part of a model: sorted hashes and their log probabilities."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        order = np.argsort(keys)
        self.keys, self.values = keys[order], values[order]

    def logs(self, lang: str, grams: np.ndarray) -> np.ndarray:
        """Log probability of each 5-gram that is in this part; 0 for all others."""
        if not len(self.keys) or not len(grams):
            return np.zeros(len(grams))
        found, inverse = np.unique(grams, return_inverse=True)
        keys = gram_keys(lang, found)
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[at] == keys, self.values[at], 0.0)[inverse]


def _blocks(model: DataFrame) -> Iterator[Block]:
    """The model in parts of about `BLOCK_GRAMS`, one at a time."""
    many = max(1, -(-model.count() // BLOCK_GRAMS))
    for part in range(many):
        rows = model.where(F.pmod("key", F.lit(many)) == part).toArrow()
        yield Block(rows.column("key").to_numpy(), rows.column("value").to_numpy())


_SCORES = "n_grams:long,log_sum:double,square_sum:double"


def _scores_udf(block, with_counts: bool) -> Callable[[Column, Column], Column]:
    """5-grams of a text, and the sums of their log probabilities and of the squares of
    those, as far as they are in a block; on request the base counts too."""
    names = [n.split(":")[0] for n in _SCORES.split(",")]

    def run(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for langs, texts in batches:
            counts = {**base_counts(texts), "sketch": sketches(texts)} if with_counts else {}
            scores = [np.zeros(len(texts), np.int64), np.zeros(len(texts)), np.zeros(len(texts))]
            for lang, places, some in _runs(langs.to_pylist(), texts.to_pylist()):
                grams, per = text_grams(some)
                logs = block.value.logs(lang, grams)
                ends = np.cumsum(per)
                for place, start, end in zip(places, (ends - per).tolist(), ends.tolist(), strict=True):
                    own = logs[start:end]
                    scores[0][place], scores[1][place], scores[2][place] = end - start, own.sum(), own @ own
            arrays = [pa.array(counts[n]) for n in counts] + [pa.array(c) for c in scores]
            yield pa.StructArray.from_arrays(arrays, [*counts, *names])

    base = ",".join(f"{n}:long" for n in [*_BASE, "sketch"]) + "," if with_counts else ""
    return F.arrow_udf(lean(run), f"struct<{base}{_SCORES}>")


def _scored(docs: DataFrame, model: DataFrame) -> DataFrame:
    """`doc_id, lang, own, same`, the base counts, sketch and scores of each row; `same` is
    equal for equal texts. Several blocks are read for each distinct text, and their sums
    joined."""
    spark = docs.sparkSession
    same = F.sha2(F.coalesce(text_bytes(), F.lit(b"")), 256).alias("same")
    texts = docs.select("doc_id", F.col("lang").cast("string"), _language().alias("own"), same, text_bytes().alias("text"))
    rows, sums = None, []
    for block in _blocks(model):
        shared = spark.sparkContext.broadcast(block)
        scores = _scores_udf(shared, rows is None)(F.col("own"), F.col("text")).alias("m")
        if rows is None:
            rows = materialise(texts.select("doc_id", "lang", "own", "same", scores).select("doc_id", "lang", "own", "same", "m.*"), "quality")
        else:
            part = texts.select("own", "same", scores).groupBy("own", "same").agg(F.first("m").alias("m"))
            sums.append(materialise(part.select("own", "same", "m.log_sum", "m.square_sum"), "quality-block"))
        shared.unpersist()
    if sums:
        more = functools.reduce(DataFrame.unionByName, sums).groupBy("own", "same").agg(
            F.sum("log_sum").alias("log_more"), F.sum("square_sum").alias("square_more")
        )
        rows = rows.join(more, ["own", "same"]).withColumns(
            {"log_sum": F.col("log_sum") + F.col("log_more"), "square_sum": F.col("square_sum") + F.col("square_more")}
        )
    return rows


def quality(docs: DataFrame, *, spreads: float = BAND_SPREADS) -> DataFrame:
    """One row per document: `doc_id, lang, n_words, word_chars, n_symbols, n_dup_lines,
    n_repeat_words, perplexity, lower, upper, base_failed, kept`.

    Words end at ASCII white space. `base_failed`: fewer than 50 words, or more than half
    of them in runs of three that the text repeats. Otherwise a document is kept if its
    perplexity (per byte of its words, the spaces between them and the end) is inside its
    language's band: the quartiles of that language's texts of 50 words and more, copies
    counted once and near copies together as their mean, widened by `spreads` times their distance on the logarithmic
    scale. Few or similar texts can squeeze that distance to nothing, and short texts vary
    more than long ones; it counts as no less than that of texts which draw as many bytes as the document
    has at random, by the variance of the language's log probabilities. A null language has a
    model of its own; a null or blank text has no words, and its perplexity is null.
    """
    rows = _scored(docs, fit(docs)).withColumn(
        # Rounded, so that equal texts have equal values in whatever company they were added up.
        "log_perplexity", F.round(-F.try_divide(F.col("log_sum"), F.col("n_grams")), 9)
    )
    long = rows.where((F.col("n_words") >= MIN_WORDS) & F.col("log_perplexity").isNotNull())
    # Copies count once, and near copies together as one text: their mean.
    scores = ("log_perplexity", "n_grams", "log_sum", "square_sum")
    texts = long.groupBy("own", "sketch", "same").agg(*(F.min(c).alias(c) for c in scores))
    texts = texts.groupBy("own", "sketch").agg(*(F.avg(c).alias(c) for c in scores))
    texts = texts.withColumn("log_perplexity", F.round("log_perplexity", 9))
    quartiles = texts.groupBy("own").agg(
        F.percentile_approx("log_perplexity", [0.25, 0.75], 10_000).alias("q"),
        (F.sum("square_sum") / F.sum("n_grams") - F.pow(F.sum("log_sum") / F.sum("n_grams"), F.lit(2))).alias("variance"),
    )
    rows = rows.join(quartiles, "own", "left")
    least = _NORMAL_SPREAD * F.sqrt(F.try_divide(F.greatest(F.col("variance"), F.lit(0.0)), F.col("n_grams")))
    wide = F.greatest(F.col("q")[1] - F.col("q")[0], least) * spreads
    band = {"lower": F.exp(F.col("q")[0] - wide), "upper": F.exp(F.col("q")[1] + wide)}
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    inside = F.col("perplexity").between(F.col("lower"), F.col("upper"))
    return (
        rows.withColumns({"perplexity": F.exp("log_perplexity"), **band})
        .select("doc_id", "lang", *_BASE, "perplexity", "lower", "upper", failed.alias("base_failed"))
        .withColumn("kept", ~F.col("base_failed") & F.coalesce(inside, F.lit(True)))
    )
