"""Operator 3: best-fit packing of tokenised documents into sequences of fixed length.

Tokenising is narrow. Only the pieces' lengths are shuffled, into groups of a bounded
number of documents; each group is packed online with a fixed number of open bins.
"""

from __future__ import annotations

import base64
import functools
import json
import os
import zlib
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .tables import lean, materialise

SEQUENCE_TOKENS = 1024
END_ID = 2
# Open bins of a group, and documents in a group: what stays open at the end of a group is
# all that packing in groups can cost.
OPEN_BINS = 1024
GROUP_DOCS = 25_000


class Vocabulary(NamedTuple):
    """A byte-level BPE vocabulary: the file for `tokenizers`, and optionally the same one as
    ranks for `tiktoken` with the pattern that splits texts."""

    tokenizer: str
    ranks: str | None = None
    pattern: str = ""
    added: tuple[str, ...] = ()  # tokens that texts may spell out


def default_vocabulary() -> Vocabulary:
    import public_tokenizers

    path = public_tokenizers.path
    with open(path("byte_bpe_50k.json"), encoding="utf-8") as file:
        added = tuple(t["content"] for t in json.load(file)["added_tokens"])
    return Vocabulary(path("byte_bpe_50k.json"), path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, added)


class Encoder:
    """Token ids of texts, as `tokenizers` gives them without adding special tokens.

    Given ranks, `tiktoken` finds the same ids four times as fast; texts that spell out an
    added token still go through `tokenizers`, which takes it for that token.
    """

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        self.ranked = None
        if vocabulary.ranks:
            import tiktoken

            with open(vocabulary.ranks, "rb") as lines:
                ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
            self.ranked = tiktoken.Encoding(
                "ranked", pat_str=vocabulary.pattern, mergeable_ranks=ranks, special_tokens={}
            )

    @functools.cached_property
    def tokenizer(self):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # the tasks are the parallelism
        from tokenizers import Tokenizer

        return Tokenizer.from_file(self.vocabulary.tokenizer)

    def encode(self, text: str) -> bytes:
        """The ids as little-endian 32-bit numbers."""
        if self.ranked is None or any(token in text for token in self.vocabulary.added):
            return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        return self.ranked.encode_to_numpy(text, disallowed_special=()).astype("<u4").tobytes()


@functools.lru_cache(maxsize=2)
def _encoder(vocabulary: Vocabulary) -> Encoder:
    return Encoder(vocabulary)


def cut(n: int, size: int) -> list[tuple[int, int]]:
    """Start and length of the pieces of a document of `n` ids; the first may be shorter."""
    first = (n - 1) % size + 1
    return [(0, first), *((start, size) for start in range(first, n, size))]


_PIECE = "piece:int,start:long,length:long,ids_crc32:long"


def _pieces_udf(vocabulary: Vocabulary, size: int, end_id: int, with_ids: bool) -> Callable[[Column], Column]:
    end = np.array([end_id], "<u4").tobytes()
    fields = [("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())]
    fields += [("ids", pa.binary())] if with_ids else []

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        encoder = _encoder(vocabulary)
        for texts in batches:
            counts, rows = [], []
            for text in texts:
                ids = encoder.encode(text.as_py() or "") + end
                found = cut(len(ids) // 4, size)
                counts.append(len(found))
                for k, (start, length) in enumerate(found):
                    own = ids[4 * start : 4 * (start + length)]
                    rows.append((k, start, length, zlib.crc32(own), own if with_ids else None))
            columns = list(zip(*rows, strict=True)) if rows else [[]] * 5
            arrays = [pa.array(c, kind) for c, (_, kind) in zip(columns, fields, strict=False)]
            pieces = pa.StructArray.from_arrays(arrays, [name for name, _ in fields])
            offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
            yield pa.ListArray.from_arrays(pa.array(offsets), pieces)

    ids = ",ids:binary" if with_ids else ""
    return F.arrow_udf(lean(run), f"array<struct<{_PIECE}{ids}>>")


def token_pieces(
    docs: DataFrame,
    *,
    vocabulary: Vocabulary | None = None,
    size: int = SEQUENCE_TOKENS,
    end_id: int = END_ID,
    with_ids: bool = False,
) -> DataFrame:
    """`doc_id, piece, start, length, ids_crc32` (and `ids`, little-endian 32-bit) per piece.

    A document is its ids and `end_id`; a null text is empty, so it is `end_id` alone. Only
    documents of more than `size` ids are cut, into pieces of `size`, the first one shorter.
    """
    pieces = _pieces_udf(vocabulary or default_vocabulary(), size, end_id, with_ids)
    rows = docs.select("doc_id", F.explode(pieces(F.col("text").cast("string"))).alias("p"))
    return rows.select("doc_id", "p.*")


class BestFit:
    """Bins of one group: those open are found by free space through a set of bits."""

    def __init__(self, size: int, open_bins: int):
        self.size, self.limit = size, open_bins
        self.free = 0  # bit f: some open bin has f places free
        self.bins: list[list[int]] = [[] for _ in range(size + 1)]
        self.n_open = self.next = 0

    def _take(self, free: int) -> int:
        found = self.bins[free].pop()
        if not self.bins[free]:
            self.free &= ~(1 << free)
        self.n_open -= 1
        return found

    def place(self, length: int) -> tuple[int, int]:
        """Bin and offset for a piece: the open bin that it fills most, or else a new one.

        Where a new bin would be one too many, the fullest closes.
        """
        fits = self.free >> length
        if fits:
            free = length + (fits & -fits).bit_length() - 1
            at = self._take(free)
        else:
            free, at = self.size, self.next
            self.next += 1
        left = free - length
        if left:
            if self.n_open == self.limit:
                fullest = (self.free & -self.free).bit_length() - 1
                if left <= fullest:
                    return at, self.size - free
                self._take(fullest)
            self.bins[left].append(at)
            self.free |= 1 << left
            self.n_open += 1
        return at, self.size - free


def _packer(size: int, open_bins: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, bins = None, None
        for batch in batches:
            sequence, offset = [], []
            groups = batch.column("pack_group").to_pylist()
            for now, length in zip(groups, batch.column("length").to_pylist(), strict=True):
                if now != group:
                    group, bins = now, BestFit(size, open_bins)
                at, start = bins.place(length)
                sequence.append((group << 40) + at)
                offset.append(start)
            columns = [batch.column(i) for i, n in enumerate(batch.schema.names) if n != "pack_group"]
            names = [n for n in batch.schema.names if n != "pack_group"]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(sequence, pa.int64()), pa.array(offset, pa.int64())],
                [*names, "sequence_id", "offset"],
            )

    return run


def pack(
    pieces: DataFrame,
    n_docs: int,
    *,
    size: int = SEQUENCE_TOKENS,
    open_bins: int = OPEN_BINS,
    group_docs: int = GROUP_DOCS,
) -> DataFrame:
    """The pieces with `sequence_id` and `offset`: where each of them goes.

    Pieces are dealt into one group per `group_docs` documents by a hash and packed in the
    order of that hash, so that a repeated run gives the same result.
    """
    n_groups = max(1, -(-n_docs // group_docs))
    order = F.xxhash64("doc_id", "piece", "ids_crc32", "length")
    rows = pieces.withColumn("pack_group", F.pmod(order, F.lit(n_groups)))
    rows = rows.repartition(n_groups, "pack_group")
    rows = rows.sortWithinPartitions("pack_group", F.xxhash64(order), "doc_id", "piece")
    fields = [f for f in rows.schema.fields if f.name != "pack_group"]
    out = T.StructType([*fields, T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])
    return rows.mapInArrow(lean(_packer(size, open_bins)), out)


def pack_documents(docs: DataFrame, **options) -> DataFrame:
    """`doc_id, piece, start, length, ids_crc32, sequence_id, offset` of all documents.

    Repeated rows are documents of their own. No documents give no rows.
    """
    return pack(token_pieces(docs, **options), docs.count())


def sequences(packed: DataFrame) -> DataFrame:
    """`sequence_id, n_tokens, ids` of packed pieces with ids: the sequences themselves."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "doc_id", "piece", "ids")))
    joined = F.aggregate(parts, F.unhex(F.lit("")), lambda all_, p: F.concat(all_, p["ids"]))
    return packed.groupBy("sequence_id").agg(F.sum("length").alias("n_tokens"), joined.alias("ids"))


def write_sequences(docs: DataFrame, path: str, **options) -> None:
    """Tokenise, pack and write the sequences as Parquet."""
    pieces = materialise(token_pieces(docs, with_ids=True, **options), "pieces")
    sequences(pack(pieces, docs.count())).write.parquet(path)
