"""Operator 8: near-duplicate documents by SuperMinHash, banding, verification, union-find.

Equal shingle sets are one node. Its signature has 384 values: 48 bands of 8 rows find a
pair at the threshold of 0.8 with probability above 0.9998, and documents that share half
their shingles almost never. Every link is confirmed on the full sets.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import hashing
from .linking import link_components
from .tables import computed_once, free_names, in_filter, key_filter, lean, materialise, text_bytes

SHINGLE_WORDS = 5
THRESHOLD = 0.8
BANDS, ROWS = 48, 8
# Similarity that sketches must suggest for a pair to be verified (four standard deviations
# under 0.8 at 384 values).
SKETCH_FLOOR = 0.71

_MARKS = "struct<n_shingles:long,fp1:long,fp2:long,keys:array<long>,sketch:array<long>>"


def _sets(data: np.ndarray, offsets: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    words, bounds = hashing.word_hashes(data, offsets)
    return hashing.distinct(*hashing.shingles(words, bounds, size))


def marks_udf(size: int, bands: int, rows: int) -> Callable[[Column], Column]:
    """Size, identity, band keys and sketch of the shingle set of each text (as bytes)."""

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            parts = []
            for data, offsets in hashing.chunks(texts):
                values, bounds = _sets(data, offsets, size)
                counts = np.diff(bounds)
                fp1, fp2 = hashing.set_digests(values, bounds)
                signature = hashing.superminhash(values, bounds, bands * rows)
                keys = hashing.band_keys(signature, rows)
                sketch = hashing.low_bits(signature).reshape(-1)
                full = counts > 0
                parts.append(
                    pa.StructArray.from_arrays(
                        [
                            pa.array(counts.astype(np.int64)),
                            pa.array(fp1.view(np.int64)),
                            pa.array(fp2.view(np.int64)),
                            hashing.lists(pa.array(keys[full].reshape(-1)), full * bands),
                            hashing.lists(pa.array(sketch), np.full(len(counts), bands * rows // 16)),
                        ],
                        ["n_shingles", "fp1", "fp2", "keys", "sketch"],
                    )
                )
            yield pa.concat_arrays(parts) if parts else pa.array([], pa_marks)

    pa_marks = pa.struct(
        [
            ("n_shingles", pa.int64()),
            ("fp1", pa.int64()),
            ("fp2", pa.int64()),
            ("keys", pa.list_(pa.int64())),
            ("sketch", pa.list_(pa.int64())),
        ]
    )
    return F.arrow_udf(lean(run), _MARKS)


def _set_udf(size: int, wanted) -> Callable[[Column, Column], Column]:
    """Identity and sorted shingle hashes of the texts whose key is in the filter, else null."""

    def run(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for keys, texts in batches:
            hit = in_filter(wanted.value, keys.to_numpy(zero_copy_only=False))
            nodes, contents = [], []
            for data, offsets in hashing.chunks(texts.filter(pa.array(hit))):
                values, bounds = _sets(data, offsets, size)
                nodes.append(hashing.set_digests(values, bounds)[0].view(np.int64))
                contents += [values[a:b].tobytes() for a, b in zip(bounds, bounds[1:], strict=False)]
            node = np.zeros(len(hit), np.int64)
            node[hit] = np.concatenate(nodes) if nodes else []
            content = np.full(len(hit), None, object)
            content[hit] = contents
            yield pa.StructArray.from_arrays(
                [pa.array(node, mask=~hit), pa.array(content, pa.binary())], ["node", "content"]
            )

    return F.arrow_udf(lean(run), "struct<node:long,content:binary>")


def similar_sets(threshold: float) -> Callable[[list[bytes], np.ndarray, np.ndarray], np.ndarray]:
    """Decides which pairs (by index) of sorted sets have a Jaccard similarity that is high enough."""
    percent = round(threshold * 100)

    def decide(sets: list[bytes], a: np.ndarray, b: np.ndarray) -> np.ndarray:
        out = np.zeros(len(a), bool)
        for k, (one, two) in enumerate(zip(a, b, strict=True)):
            both = np.concatenate([np.frombuffer(sets[one], np.uint64), np.frombuffer(sets[two], np.uint64)])
            both.sort()
            shared = int(np.count_nonzero(both[1:] == both[:-1]))
            out[k] = 100 * shared >= percent * (len(both) - shared)
        return out

    return decide


def _identity_udf(size: int) -> Callable[[Column], Column]:
    """Identity of the shingle set of each text; null where it is empty."""

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            parts = [pa.array([], pa.int64())]
            for data, offsets in hashing.chunks(texts):
                values, bounds = _sets(data, offsets, size)
                digests = hashing.set_digests(values, bounds)[0].view(np.int64)
                parts.append(pa.array(digests, mask=np.diff(bounds) == 0))
            yield pa.concat_arrays(parts)

    return F.arrow_udf(lean(run), "long")


def _components(docs: DataFrame, size: int, threshold: float, bands: int, rows: int) -> DataFrame:
    """`doc_id, n_shingles, node, component_id` of each document."""
    marked = docs.select("doc_id", marks_udf(size, bands, rows)(text_bytes()).alias("m"))
    marked = materialise(marked.select("doc_id", "m.*"), "near-marks")
    nodes = (
        marked.where("n_shingles > 0")
        .groupBy(F.col("fp1").alias("node"), "fp2")
        .agg(
            F.min("doc_id").alias("doc_id"),
            F.first("keys").alias("keys"),
            F.first("sketch").alias("sketch"),
        )
    )
    nodes = materialise(nodes, "near-nodes")

    def contents_of(wanted: DataFrame) -> DataFrame:
        chosen = nodes.select("node", "doc_id").join(wanted, "node", "left_semi")
        keys = key_filter(chosen, F.xxhash64("doc_id"))
        found = docs.select(_set_udf(size, keys)(F.xxhash64("doc_id"), text_bytes()).alias("s"))
        found = computed_once(found, "s")
        return found.where("s.content is not null").select("s.*").dropDuplicates(["node"])

    roots = link_components(nodes, contents_of, similar_sets(threshold), SKETCH_FLOOR)
    named = nodes.select("node", "doc_id").join(roots, "node", "left")
    named = named.withColumn("root", F.coalesce("root", "node"))
    least = named.groupBy("root").agg(F.min("doc_id").alias("least"))
    least = named.join(least, "root").select("node", "least")
    has = F.col("n_shingles") > 0
    return (
        marked.select("doc_id", "n_shingles", F.when(has, F.col("fp1")).alias("node"))
        .join(least, "node", "left")
        .select(
            "doc_id", "n_shingles", "node", F.when(has, F.col("least")).otherwise(F.col("doc_id")).alias("component_id")
        )
    )


def near_duplicates(
    docs: DataFrame,
    *,
    shingle_words: int = SHINGLE_WORDS,
    threshold: float = THRESHOLD,
    bands: int = BANDS,
    rows: int = ROWS,
) -> DataFrame:
    """One row per document: `doc_id, n_shingles, component_id, kept`.

    Documents are linked where the Jaccard similarity of their sets of word shingles
    (words end at ASCII white space, A-Z count as a-z; fewer words than a shingle has are
    one shingle) is at least `threshold`. `component_id` is the least doc_id that can be
    reached, and the document that has it is kept. A null or blank text has no shingle and
    is linked with nothing. Rows with one doc_id are rows of their own; where it is the
    component's, all of them are kept. A component without any doc_id is kept whole.
    """
    found = _components(docs, shingle_words, threshold, bands, rows)
    kept = F.col("doc_id").eqNullSafe(F.col("component_id"))
    return found.select("doc_id", "n_shingles", "component_id", kept.alias("kept"))


def drop_near_duplicates(
    docs: DataFrame,
    *,
    shingle_words: int = SHINGLE_WORDS,
    threshold: float = THRESHOLD,
    bands: int = BANDS,
    rows: int = ROWS,
) -> DataFrame:
    """The kept documents of `near_duplicates`, with all their columns."""
    found = _components(docs, shingle_words, threshold, bands, rows)
    goes = found.where(~F.col("doc_id").eqNullSafe(F.col("component_id")))
    mine, identity = free_names(docs, "set_identity", "dropped_id")
    goes = goes.select(F.col("doc_id").alias(identity), F.col("node").alias(f"{mine}_of")).distinct()
    named = docs.withColumn(mine, _identity_udf(shingle_words)(text_bytes()))
    same = F.col("doc_id").eqNullSafe(F.col(identity)) & (F.col(mine) == F.col(f"{mine}_of"))
    return named.join(goes, same, "left_anti").drop(mine)
