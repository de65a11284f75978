"""Byte-level BPE ids of whole texts, and their bytes again."""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from meterlake.llm.common import id_and_text
from meterlake.llm.vocabulary import Decoder, default_path, merging_pieces

RANKS = "byte_bpe_50k.tiktoken"

_SCHEMA = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("n_tokens", pa.int64()),
        ("ids_sha256", pa.string()),
        ("decoded_sha256", pa.string()),
    ]
)


@functools.lru_cache(maxsize=1)
def _decoder(path: str) -> Decoder:
    return Decoder(merging_pieces(path)[1].ranks)


def encode_batches(path: str, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Ids of each text, as little-endian 32-bit integers, with the text's id column."""
    pieces, _ = merging_pieces(path)
    for batch in batches:
        texts = batch.column("text").to_pylist()
        ids: list[bytes] = []
        open_parts: list[bytes] = []
        for _, ended, part, _ in pieces.encode(texts):
            open_parts.append(part.astype("<u4").tobytes())
            if ended:
                ids.append(b"".join(open_parts))
                open_parts = []
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(ids, pa.large_binary())], ["doc_id", "ids"]
        )


def encode_texts(
    docs: DataFrame,
    ranks_path: str,
    *,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """doc_id and ids (binary, little-endian 32-bit) of every whole text.

    Each block of documents is a corpus of its own: its new words are merged together, by
    rank, from an index of token pairs, and every text takes the ids of its words. Nothing
    is shuffled, and a worker keeps a bounded table of words. A null text is empty and has
    no ids; repeated rows give repeated results; an empty table gives no rows.
    """
    return id_and_text(docs, id_column, text_column).mapInArrow(
        functools.partial(encode_batches, ranks_path), "doc_id long, ids binary"
    )


def _digests(path: str, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    pieces, _ = merging_pieces(path)
    decode = _decoder(path)
    for batch in batches:
        rows: list[tuple[int, str, str]] = []
        count, of_ids, of_bytes = 0, hashlib.sha256(), hashlib.sha256()
        for _, ended, ids, _ in pieces.encode(batch.column("text").to_pylist()):
            count += len(ids)
            of_ids.update(ids.astype("<u4").tobytes())
            of_bytes.update(decode(ids))
            if ended:
                rows.append((count, of_ids.hexdigest(), of_bytes.hexdigest()))
                count, of_ids, of_bytes = 0, hashlib.sha256(), hashlib.sha256()
        columns = list(zip(*rows)) or [[], [], []]
        results = [pa.array(column, kind) for column, kind in zip(columns, _SCHEMA.types[1:])]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *results], schema=_SCHEMA)


def round_trip(
    docs: DataFrame,
    *,
    id_column: str = "doc_id",
    text_column: str = "text",
    ranks_path: str | None = None,
) -> DataFrame:
    """One row per document: digests of the ids of its text and of the ids decoded again.

    Columns: doc_id, n_tokens, ids_sha256, decoded_sha256. Cases as in ``encode_texts``.
    """
    path = ranks_path or default_path(RANKS)
    return id_and_text(docs, id_column, text_column).mapInArrow(
        functools.partial(_digests, path),
        "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string",
    )
