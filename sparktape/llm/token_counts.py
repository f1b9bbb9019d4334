"""Operator 13: token counts of whole texts, huge ones in overlapping chunks.

A text of at most `CHUNK_BYTES` is encoded at once. A longer one is encoded in chunks that
overlap, with the byte offsets of their tokens, and the chunks are spliced where both have
a token border that no context can move: between two characters that stand next to each
other in no piece of the vocabulary, so that no merge ever joins them. An overlap without
such a border is widened until it has one, in the last resort to the end of the text. So
memory is bounded by the chunk wherever the text has any such border, and the count is
that of the whole text in all cases.
"""

from __future__ import annotations

import functools
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .tables import free_names, lean, text_bytes

CHUNK_BYTES = 1 << 16
OVERLAP_BYTES = 1 << 8
TOKEN_LIMIT = 4096
# What sentencepiece puts in the place of a space.
SPACE = "▁"


def default_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


class PieceEncoder:
    """A sentencepiece model: token counts, token offsets, and which borders are stable.

    Borders are stable for models that leave the characters of a text as they are and fall
    back to bytes for unknown ones, as the default one does.
    """

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)

    def count(self, text: bytes) -> int:
        return len(self.model.encode(text, num_threads=1))

    def begins(self, text: bytes) -> np.ndarray:
        """The byte at which each token begins, in order."""
        from sentencepiece import sentencepiece_pb2

        found = sentencepiece_pb2.SentencePieceText()
        found.ParseFromString(self.model.encode(text, return_type="serialized_proto"))
        return np.fromiter((p.begin for p in found.pieces), np.int64, len(found.pieces))

    @functools.cached_property
    def joined(self) -> frozenset[str]:
        """Each two characters that follow each other in some piece."""
        model, found = self.model, set()
        for i in range(model.get_piece_size()):
            if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i)):
                piece = model.id_to_piece(i)
                found.update(a + b for a, b in zip(piece, piece[1:], strict=False))
        return frozenset(found)

    def stable_borders(self, text: bytes) -> Iterator[int]:
        """Bytes of `text` at which a token begins whatever comes before or after; none in
        bytes that are not UTF-8."""
        try:
            characters = text.decode().replace(" ", SPACE)
        except UnicodeDecodeError:
            return
        at = 0
        for a, b in zip(characters, characters[1:], strict=False):
            # The mark of a space is three bytes long, the space that it stands for one; a
            # mark that the text itself holds is told apart by its bytes.
            at += 1 if text[at] < 0x80 else len(a.encode())
            if a + b not in self.joined:
                yield at


@functools.lru_cache(maxsize=2)
def _encoder(path: str) -> PieceEncoder:
    return PieceEncoder(path)


def _character_start(text: bytes, at: int) -> int:
    while at < len(text) and text[at] & 0xC0 == 0x80:
        at += 1
    return at


def count_spliced(
    encoder: PieceEncoder, text: bytes, chunk: int = CHUNK_BYTES, overlap: int = OVERLAP_BYTES
) -> int:
    """Tokens of a text, from chunks of about `chunk` bytes that overlap by `overlap` or more."""
    n, total, low, spliced = len(text), 0, 0, 0
    while True:
        following = _character_start(text, min(low + chunk, n))
        width = overlap
        while True:
            high = _character_start(text, min(following + width, n))
            begins = encoder.begins(text[low:high]) + low
            if low and not np.any(begins == spliced):
                return encoder.count(text)  # the chunks do not agree on the border
            if high == n:
                return total + int(np.count_nonzero(begins >= spliced))
            known = set(begins[begins > following].tolist())
            borders = (following + b for b in encoder.stable_borders(text[following:high]))
            border = next((b for b in borders if b in known), None)
            if border is not None:
                break
            width *= 2
        total += int(np.count_nonzero((begins >= spliced) & (begins < border)))
        low, spliced = following, border


def _counts_udf(model: str, chunk: int, overlap: int) -> Callable[[Column], Column]:
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        encoder = _encoder(model)
        for texts in batches:
            counts = []
            for value in texts:
                text = value.as_py() or b""
                if len(text) <= chunk:
                    counts.append(encoder.count(text))
                else:
                    counts.append(count_spliced(encoder, text, chunk, overlap))
            yield pa.array(counts, pa.int64())

    return F.arrow_udf(lean(run), "long")


def with_token_counts(
    docs: DataFrame,
    *,
    model: str | None = None,
    limit: int = TOKEN_LIMIT,
    chunk: int = CHUNK_BYTES,
    overlap: int = OVERLAP_BYTES,
) -> DataFrame:
    """The rows with `n_bytes`, `n_tokens` and `over_limit` (more than `limit` tokens).

    Tokens are those of the whole text as the sentencepiece model gives them, without begin
    or end; strings that look like special tokens are ordinary text. A null text counts as
    empty: no bytes, no tokens. All rows stay, repeated ones too; columns of these three
    names are replaced. One narrow step: a text is counted in one task, in bounded memory.
    """
    (encoded,) = free_names(docs, "encoded")
    count = _counts_udf(model or default_model(), chunk, overlap)
    rows = docs.drop("n_bytes", "n_tokens", "over_limit").withColumn(encoded, text_bytes())
    rows = rows.withColumn("n_bytes", F.coalesce(F.octet_length(encoded), F.lit(0)).cast("long"))
    rows = rows.withColumn("n_tokens", count(F.col(encoded))).drop(encoded)
    return rows.withColumn("over_limit", F.col("n_tokens") > F.lit(limit))
