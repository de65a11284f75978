"""Packing along a space-filling curve: similar documents share sequences."""

from __future__ import annotations

import functools
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterlake.llm.common import id_and_text, range_bounds, range_of, ranges_for, stage
from meterlake.llm.vocabulary import default_path, library_pieces

TOKENIZER = "byte_bpe_50k.json"
END_ID = 1
LENGTH = 2048
#: The curve runs through this many dimensions of so many bits each; ties go by these bits.
DIMENSIONS, BITS, TIE_BITS = 4, 10, 12
#: A document weighs one for so many ids when ranges are cut; a stored id takes so many bytes.
WEIGHT_TOKENS, TOKEN_BYTES = 512, 2
#: A mean of projected pieces this large lies a quarter of the range from the middle.
SPREAD = 0.08

_ENCODED = "doc_id long, place long, doc_tokens long, ids binary"
_PIECES = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
    "sequence_id long, offset long"
)
_PIECE_NAMES = [part.split()[0] for part in _PIECES.split(", ")]


def hilbert_keys(points: np.ndarray, bits: int) -> np.ndarray:
    """Place on the Hilbert curve of each row of unsigned coordinates (Skilling 2004)."""
    x = points.astype(np.uint64).T.copy()
    count = len(x)
    one = np.uint64(1)
    q = one << np.uint64(bits - 1)
    while q > one:
        p = q - one
        for i in range(count):
            flip = (x[i] & q) != 0
            swap = (x[0] ^ x[i]) & p
            x[0] = np.where(flip, x[0] ^ p, x[0] ^ swap)
            if i:
                x[i] = np.where(flip, x[i], x[i] ^ swap)
        q >>= one
    for i in range(1, count):
        x[i] ^= x[i - 1]
    turn = np.zeros(x.shape[1], dtype=np.uint64)
    q = one << np.uint64(bits - 1)
    while q > one:
        turn ^= np.where((x[count - 1] & q) != 0, q - one, np.uint64(0))
        q >>= one
    x ^= turn
    key = np.zeros(x.shape[1], dtype=np.uint64)
    for bit in range(bits - 1, -1, -1):
        for i in range(count):
            key = (key << one) | ((x[i] >> np.uint64(bit)) & one)
    return key


def _coordinates(sums: np.ndarray, pieces: np.ndarray) -> np.ndarray:
    """Grid coordinates of the mean projection of each document's pieces."""
    mean = sums / np.maximum(pieces, 1)[:, None] / (1 << 15)
    share = np.arctan(mean / SPREAD) / np.pi + 0.5
    return np.clip(share * (1 << BITS), 0, (1 << BITS) - 1).astype(np.uint64)


def _project(hashes: np.ndarray) -> np.ndarray:
    """Sum of the pieces' projections: each hash holds its piece's coordinates."""
    words = hashes.astype("<u8").view("<u2").reshape(-1, DIMENSIONS)
    return words.sum(axis=0, dtype=np.float64) - 32767.5 * len(words)


def _encode(path: str, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    pieces = library_pieces(path, END_ID)
    for batch in batches:
        count = batch.num_rows
        sums = np.zeros((count, DIMENSIONS))
        lengths = np.zeros(count, np.int64)
        sizes = np.zeros(count, np.int64)
        ids: list[bytes] = []
        parts: list[bytes] = []
        for number, ended, part, hashes in pieces.encode(batch.column("text").to_pylist()):
            sums[number] += _project(hashes)
            lengths[number] += len(hashes)
            sizes[number] += len(part)
            parts.append(part.astype("<u4").tobytes())
            if ended:
                ids.append(_narrow(b"".join(parts)))
                parts = []
        known = batch.column("doc_id").fill_null(-1).to_numpy(zero_copy_only=False)
        tie = (known.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - TIE_BITS)
        place = (hilbert_keys(_coordinates(sums, lengths), BITS) << np.uint64(TIE_BITS)) | tie
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"),
                pa.array(place.astype(np.int64)),
                pa.array(sizes),
                pa.array(ids, pa.large_binary()),
            ],
            ["doc_id", "place", "doc_tokens", "ids"],
        )


def _narrow(ids: bytes) -> bytes:
    """Ids in two bytes each where all fit, marked by a first byte."""
    wide = np.frombuffer(ids, "<u4")
    if wide.size and wide.max() >= 1 << 16:
        return b"\4" + ids
    return b"\2" + wide.astype("<u2").tobytes()


def _wide(stored: bytes) -> np.ndarray:
    return np.frombuffer(stored, "<u2" if stored[0] == 2 else "<u4", offset=1).astype("<u4")


def _cut(
    before: list[int], length: int, batches: Iterator[pa.RecordBatch]
) -> Iterator[pa.RecordBatch]:
    """Pieces of the documents of a stretch, in order; ``before`` has the ids of earlier ones."""
    at: dict[int, int] = {}
    for batch in batches:
        rows: list[tuple] = []
        columns = [batch.column(c).to_pylist() for c in ("doc_id", "stretch", "ids")]
        for doc_id, stretch, stored in zip(*columns):
            ids = _wide(stored)
            first = at.setdefault(stretch, before[stretch])
            at[stretch] = first + len(ids)
            start = 0
            while start < len(ids):
                sequence, offset = divmod(first + start, length)
                part = ids[start : start + length - offset]
                crc = zlib.crc32(part.tobytes())
                rows.append((doc_id, start, len(part), crc, len(ids), sequence, offset))
                start += len(part)
        columns = list(zip(*rows)) or [[]] * len(_PIECE_NAMES)
        yield pa.RecordBatch.from_arrays(
            [pa.array(column, pa.int64()) for column in columns], _PIECE_NAMES
        )


def pack_documents(
    docs: DataFrame,
    *,
    id_column: str = "doc_id",
    text_column: str = "text",
    length: int = LENGTH,
    tokenizer_path: str | None = None,
) -> DataFrame:
    """All documents in sequences of ``length`` tokens, neighbours on a Hilbert curve together.

    A document is the ids of its text and an end id. The counts of its pieces, projected
    by the pieces' hashes to a few dimensions, give its place on the curve; documents are
    range-sorted by place, and the ids, laid end to end, are cut every ``length``. So only
    the last sequence needs padding. Ranges are even in ids, not in documents: the places of
    long texts lie close together, as their means do; there are more ranges for more ids. The
    counts of ids per range, one number for each
    range, tell where each range begins.

    Columns: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset. A null or
    empty text is the end id alone. Equal texts have equal places, ties go by id; null ids
    and repeated rows are packed like any other; an empty table gives no rows.
    """
    path = tokenizer_path or default_path(TOKENIZER)
    spark = docs.sparkSession
    encoded = stage(
        id_and_text(docs, id_column, text_column).mapInArrow(
            functools.partial(_encode, path), _ENCODED
        ),
        "packing_ids",
    )
    tokens = encoded.agg(F.coalesce(F.sum("doc_tokens"), F.lit(0))).first()[0]
    heavy = F.ceil(F.col("doc_tokens") / WEIGHT_TOKENS).cast("int")
    bounds = range_bounds(encoded, "place", ranges_for(spark, TOKEN_BYTES * tokens), heavy)
    placed = encoded.withColumn("stretch", range_of(F.col("place"), bounds))
    sizes = [0] * (len(bounds) + 1)
    for row in placed.groupBy("stretch").agg(F.sum("doc_tokens").alias("ids")).collect():
        sizes[row["stretch"]] = row["ids"]
    before = [sum(sizes[:i]) for i in range(len(sizes))]
    return (
        placed.repartitionById(len(sizes), F.col("stretch"))
        .sortWithinPartitions("stretch", "place", "doc_id", "doc_tokens")
        .select("doc_id", "stretch", "ids")
        .mapInArrow(functools.partial(_cut, before, length), _PIECES)
    )
