"""Operator 2: near-duplicate lines by MinHash over character shingles.

Lines that are equal after normalising are one node. A node's signature is
one-permutation MinHash; 12 bands of 4 values find a pair at the threshold of 0.8 with
probability 0.998 and nearly all pairs above it; candidates are verified on their shingle sets, and
union-find keeps one line of each component: the first, by doc_id and place.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import hashing
from .linking import link_components
from .tables import computed_once, free_names, in_filter, key_filter, lean, materialise

SHINGLE_CHARS = 8
THRESHOLD = 0.8
BANDS, ROWS = 12, 4
# Values of a signature; four bits of each are compared before a pair is verified.
VALUES = 128
# Lines whose signatures are computed at once.
LINES_AT_ONCE = 512
# Nodes from which a class counts as hot.
HOT_NODES = 5_000
_RARE = "\t\r\x0b\x0c"
_RUN = re.compile(r"[ \t\n\r\x0b\x0c]+")
# Similarity that sketches must suggest for a pair to be verified (nearly five standard
# deviations under 0.8 at 128 values; those of short lines vary more).
SKETCH_FLOOR = 0.62
_BASE = 0xD1342543DE82EF95


def normal_lines(text: str) -> list[str]:
    """The lines of a text in lower case, with single spaces for runs of ASCII white space and
    none at the ends; empty for a blank one."""
    text = text.lower()
    if "  " in text or any(c in text for c in _RARE):
        return [_RUN.sub(" ", line).strip(" ") for line in text.split("\n")]
    return [line.strip(" ") for line in text.split("\n")]


def _identity(line: str) -> bytes:
    return xxhash.xxh3_128_digest(line.encode("utf-8", "surrogatepass"))


def _lines(texts: list[str | None]) -> tuple[list[str], list[int], list[int]]:
    """Normal lines that are not blank, their places in the text, and how many each text has."""
    lines, places, counts = [], [], []
    for text in texts:
        before = len(lines)
        for at, line in enumerate(normal_lines(text or "")):
            if line:
                lines.append(line)
                places.append(at)
        counts.append(len(lines) - before)
    return lines, places, counts


def _first_lines(texts: list[str | None]) -> tuple[list[str], list[tuple[int, int]], list[int]]:
    """As `_lines`, but each line once per text, with its first place and how often it is there."""
    lines, places, counts = _lines(texts)
    kept, where, at = [], [], 0
    for i, n in enumerate(counts):
        own = lines[at : at + n]
        times = Counter(own)
        kept += times
        if len(times) < n:
            first = dict(zip(reversed(own), reversed(places[at : at + n]), strict=True))
            where += [(first[line], k) for line, k in times.items()]
        else:
            where += [(place, 1) for place in places[at : at + n]]
        at, counts[i] = at + n, len(times)
    return kept, where, counts


def _shingle_hashes(lines: list[str], size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the runs of `size` characters of each line (repeats included, not mixed),
    and where each line's start; a shorter line is one run."""
    lengths = np.array([len(line) for line in lines], np.int64)
    starts = np.concatenate([[0], np.cumsum(lengths)])
    runs = np.frombuffer("".join(lines).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    # Polynomials over ever longer runs: of a length by two of half of it.
    have, base = 1, _BASE
    while have < size:
        step = min(have, size - have)
        power = pow(base, step, 1 << 64)
        longer = runs * np.uint64(power)
        longer[:-step] += runs[step:]
        # Where the two halves overlap, the overlap counts twice: as good a hash of the run.
        runs, have = longer, have + step
    valid = np.ones(len(runs), bool)
    per = np.maximum(lengths - size + 1, 1)
    ends = starts[1:]
    for back in range(1, size):
        at = ends - back
        valid[at[(at > starts[:-1]) & (lengths > 0)]] = False
    for i in np.flatnonzero(lengths < size):
        runs[starts[i]] = np.frombuffer(_identity(lines[i]), np.uint64)[0]
    return runs[valid], np.concatenate([[0], np.cumsum(per)])


def _signatures(lines: list[str], size: int) -> np.ndarray:
    """Signatures of lines, from pieces that a processor's cache holds."""
    pieces = [lines[low : low + LINES_AT_ONCE] for low in range(0, len(lines), LINES_AT_ONCE)]
    return np.concatenate([hashing.one_permutation(*_shingle_hashes(x, size), VALUES) for x in pieces])


def _line_columns(bands: int) -> tuple[list[str], list[str]]:
    """Names of the columns with the band keys and with the sketch of a line."""
    return [f"k{i}" for i in range(bands)], [f"s{i}" for i in range(VALUES // 16)]


def _marks(size: int, bands: int, rows: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A row for each of the different lines of each text: its document, first place, number,
    identity, band keys and sketch."""
    keys, sketch = _line_columns(bands)
    names = ["line_no", "times", "fp1", "fp2", *keys, *sketch]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, batch.num_rows, 256):
                some = batch.slice(low, 256)
                lines, places, counts = _first_lines(some.column(1).to_pylist())
                if not lines:
                    continue
                columns = np.empty((len(names), len(lines)), np.int64)
                digests = np.frombuffer(b"".join(map(_identity, lines)), np.int64).reshape(-1, 2)
                signature = _signatures(lines, size)
                columns[:2], columns[2:4] = np.array(places).T, digests.T
                columns[4 : 4 + bands] = hashing.band_keys(signature[:, : bands * rows], rows).T
                columns[4 + bands :] = hashing.low_bits(signature).T
                docs = some.column(0).take(pa.array(np.repeat(np.arange(len(counts)), counts)))
                yield pa.RecordBatch.from_arrays([docs, *map(pa.array, columns)], ["doc_id", *names])

    return lean(run)


_SHARED = "struct<n_lines:long,shared:array<struct<line_no:long,node:long,content:binary>>>"


def _shared_udf(docs_wanted, nodes_wanted) -> Callable[[Column, Column], Column]:
    """How many lines each text has, and place and identity of those whose identity is in the
    filter; also the line itself, if its text is in the filter too."""

    def run(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for keys, texts in batches:
            whole = in_filter(docs_wanted.value, keys.to_numpy(zero_copy_only=False))
            for low in range(0, max(len(texts), 1), 256):
                lines, places, counts = _lines(texts[low : low + 256].to_pylist())
                node = np.frombuffer(b"".join(map(_identity, lines)), np.int64).reshape(-1, 2)[:, 0]
                hit = np.flatnonzero(in_filter(nodes_wanted.value, node))
                owner = np.repeat(np.arange(len(counts)), counts)[hit]
                content = [
                    lines[i].encode("utf-8", "surrogatepass") if whole[low + o] else None
                    for i, o in zip(hit, owner, strict=True)
                ]
                at = pa.array(np.array(places, np.int64)[hit])
                found = pa.StructArray.from_arrays(
                    [at, pa.array(node[hit]), pa.array(content, pa.binary())], ["line_no", "node", "content"]
                )
                shared = hashing.lists(found, np.bincount(owner, minlength=len(counts)))
                numbers = pa.array(counts, pa.int64())
                yield pa.StructArray.from_arrays([numbers, shared], ["n_lines", "shared"])

    return F.arrow_udf(lean(run), _SHARED)


def shingle_set(line: str, size: int) -> set[str]:
    return {line[i : i + size] for i in range(max(1, len(line) - size + 1))}


def similar_lines(size: int, threshold: float) -> Callable[[list[bytes], np.ndarray, np.ndarray], np.ndarray]:
    """Decides which pairs (by index) of lines have shingle sets, as 64-bit hashes, of a
    Jaccard similarity that is high enough."""
    percent = round(threshold * 100)

    def decide(lines: list[bytes], a: np.ndarray, b: np.ndarray) -> np.ndarray:
        used, index = np.unique(np.concatenate([a, b]), return_inverse=True)
        texts = [lines[i].decode("utf-8", "surrogatepass") for i in used]
        if not texts:
            return np.zeros(0, bool)
        values, bounds = hashing.distinct(*_shingle_hashes(texts, size))
        sets = [values[low:high] for low, high in zip(bounds, bounds[1:], strict=False)]
        out = np.zeros(len(a), bool)
        for k, (one, two) in enumerate(zip(index[: len(a)], index[len(a) :], strict=True)):
            both = np.concatenate([sets[one], sets[two]])
            both.sort()
            shared = int(np.count_nonzero(both[1:] == both[:-1]))
            out[k] = 100 * shared >= percent * (len(both) - shared)
        return out

    return decide


def _place(line_no: str) -> Column:
    """Order of lines by doc_id, nulls last, then place."""
    doc = F.coalesce(F.col("doc_id").cast("decimal(20,0)"), F.expr("9223372036854775808BD"))
    place = (doc * F.expr("4294967296BD")).cast("decimal(38,0)") + F.col(line_no)
    return place.cast("decimal(38,0)")


def _with_classes(named: DataFrame, classes: DataFrame, n_nodes: int) -> DataFrame:
    """`named` joined to its classes by root. The few classes of very many nodes are sent to
    all tasks (at most 100 000 of them), so that no task gets such a class whole."""
    hot = F.col("n_nodes") > max(HOT_NODES, n_nodes // 100_000)
    large = F.broadcast(classes.where(hot).drop("n_nodes"))
    small = classes.where(~hot).drop("n_nodes")
    rest = named.join(large.select("root"), "root", "left_anti").join(small, "root")
    return named.join(large, "root").unionByName(rest)


def _dropped(docs: DataFrame, size: int, threshold: float, bands: int, rows: int) -> DataFrame:
    """`doc_id, n_lines, dropped` of each document row: how many lines it has, and those that
    are not kept, with their class."""
    text = F.col("text").cast("string")
    keys, sketch = _line_columns(bands)
    marks = ["line_no", "times", "fp1", "fp2", *keys, *sketch]
    texts = docs.select("doc_id", text.alias("text"))
    kinds = [f"doc_id {texts.dtypes[0][1]}", *(f"{n} long" for n in marks)]
    found = texts.mapInArrow(_marks(size, bands, rows), ", ".join(kinds))
    nodes = found.groupBy(F.col("fp1").alias("node"), "fp2").agg(
        F.min("doc_id").alias("doc_id"),
        F.min(_place("line_no")).alias("place"),
        F.sum("times").alias("n_lines"),
        *[F.max(n).alias(n) for n in [*keys, *sketch]],
    )
    # A column for each key: Parquet takes long to write and read lists.
    nodes = materialise(nodes.drop("fp2"), "line-nodes")
    narrow = nodes.select("node", "doc_id", "place", "n_lines")
    nodes = nodes.select("node", F.array(*keys).alias("keys"), F.array(*sketch).alias("sketch"))
    scanned: list[DataFrame] = []
    many: list[DataFrame] = []

    def contents_of(wanted: DataFrame) -> DataFrame:
        owners = materialise(narrow.join(wanted, "node", "left_semi"), "line-owners")
        many.append(narrow.where("n_lines > 1").unionByName(owners).dropDuplicates(["node"]))
        repeated = narrow.where("n_lines > 1").select("node").unionByName(owners.select("node"))
        shared = _shared_udf(key_filter(owners, F.xxhash64("doc_id")), key_filter(repeated, F.col("node")))
        row = F.xxhash64("doc_id", text).alias("row_key")
        found = docs.select("doc_id", row, shared(F.xxhash64("doc_id"), text).alias("s"))
        scanned.append(materialise(found.select("doc_id", "row_key", "s.*"), "shared-lines"))
        held = scanned[0].select(F.explode("shared").alias("l")).where("l.content is not null")
        return held.select("l.node", "l.content").dropDuplicates(["node"]).join(wanted, "node", "left_semi")

    roots = link_components(nodes, contents_of, similar_lines(size, threshold), SKETCH_FLOOR, small=True)
    heads = roots.select(F.col("root").alias("node"), "root").distinct()
    roots = roots.unionByName(heads)
    # Any other line is alone in its class.
    named = many[0].join(roots, "node", "left").where("n_lines > 1 or root is not null")
    named = named.withColumn("root", F.coalesce("root", "node"))
    named = materialise(named.select("node", "root", "doc_id", "place"), "line-classes")
    classes = named.groupBy("root").agg(
        F.min("doc_id").alias("owner"), F.min("place").alias("first"), F.count("*").alias("n_nodes")
    )
    classes = _with_classes(named.select("node", "root"), classes, named.count())
    # Of rows with one doc_id, each loses only lines of its own: equal rows have one key.
    keys = [F.col("doc_id").alias("gone_of"), F.col("row_key").alias("gone_row")]
    lines = scanned[0].select(*keys, "doc_id", F.explode("shared").alias("l"))
    lines = lines.select("gone_of", "gone_row", "doc_id", "l.line_no", "l.node").join(classes, "node")
    line = F.struct("line_no", "node", F.col("root").alias("class_id"), F.col("owner").alias("class_doc_id"))
    gone = lines.where(_place("line_no") != F.col("first"))
    gone = gone.groupBy("gone_of", "gone_row").agg(F.array_sort(F.collect_set(line)).alias("dropped"))
    mine = F.col("doc_id").eqNullSafe(F.col("gone_of")) & (F.col("row_key") == F.col("gone_row"))
    joined = scanned[0].select("doc_id", "row_key", "n_lines").join(gone, mine, "left")
    return joined.select("doc_id", "n_lines", F.coalesce("dropped", F.array()).alias("dropped"))


def duplicate_lines(
    docs: DataFrame,
    *,
    shingle_chars: int = SHINGLE_CHARS,
    threshold: float = THRESHOLD,
    bands: int = BANDS,
    rows: int = ROWS,
) -> DataFrame:
    """One row per document: `doc_id, n_lines, n_kept, dropped`.

    Lines end at a line feed and count from 0; blank ones count as none. They are compared
    in lower case with single spaces, as sets of runs of `shingle_chars` characters (a
    shorter line is one run), and linked at a Jaccard similarity of `threshold`. Of each
    class of linked lines the first line of the least doc_id is kept. `dropped` lists the
    others of a document: line_no, class_id and class_doc_id, the document that keeps the
    class's line. A null or blank text has no line; a null doc_id is larger than any other.
    Rows of one doc_id are one document: a line at the same place of several is kept in all.

    A text is read in one task, in time and memory in proportion to its length; of different
    lines that share a band, blocks of 512 are compared by their sketches.
    """
    found = _dropped(docs, shingle_chars, threshold, bands, rows)
    dropped = F.transform(
        "dropped",
        lambda d: F.struct(
            d["line_no"].alias("line_no"),
            d["class_id"].alias("class_id"),
            d["class_doc_id"].alias("class_doc_id"),
        ),
    )
    return found.select(
        "doc_id", "n_lines", (F.col("n_lines") - F.size("dropped")).alias("n_kept"), dropped.alias("dropped")
    )


def _rest_udf() -> Callable[[Column, Column], Column]:
    """Texts without the given lines; null where no line is given, empty where none is left."""

    def run(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for texts, drops in batches:
            out = []
            for value, drop in zip(texts, drops.to_pylist(), strict=True):
                text = value.as_py() if drop else None
                if text is None:
                    out.append(None)
                    continue
                goes = {(d["line_no"], d["node"]) for d in drop}
                at = {place for place, _ in goes}
                normal = normal_lines(text)
                kept = [
                    raw
                    for i, raw in enumerate(text.split("\n"))
                    if i not in at
                    or (i, int.from_bytes(_identity(normal[i])[:8], "little", signed=True)) not in goes
                ]
                out.append("\n".join(kept) if any(line.strip() for line in kept) else "")
            yield pa.array(out, pa.string())

    return F.arrow_udf(lean(run), "string")


def drop_duplicate_lines(
    docs: DataFrame,
    *,
    shingle_chars: int = SHINGLE_CHARS,
    threshold: float = THRESHOLD,
    bands: int = BANDS,
    rows: int = ROWS,
) -> DataFrame:
    """The documents, with all their columns, without the lines that are not kept.

    A document that loses all its lines goes; one that had none to begin with stays.
    """
    mine, lines, rest = free_names(docs, "lines_of", "lines_gone", "text_left")
    goes = _dropped(docs, shingle_chars, threshold, bands, rows).where(F.size("dropped") > 0)
    goes = goes.groupBy(F.col("doc_id").alias(mine)).agg(
        F.flatten(F.collect_set("dropped")).alias(lines)
    )
    joined = docs.join(goes, F.col("doc_id").eqNullSafe(F.col(mine)), "left")
    joined = joined.withColumn(rest, _rest_udf()(F.col("text").cast("string"), F.col(lines)))
    joined = computed_once(joined, rest)
    joined = joined.where(F.col(rest).isNull() | (F.col(rest) != ""))
    return joined.withColumn("text", F.coalesce(rest, "text")).select(*docs.columns)
