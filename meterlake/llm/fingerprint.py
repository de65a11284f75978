"""Fingerprints of documents that stay near when texts change a little."""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterlake.llm.common import id_and_text, parallelism, range_bounds, range_of

BUCKETS = 256
#: Places of the second and third byte of each triplet behind its first, in a window of five.
TRIPLETS = ((1, 2), (1, 3), (2, 3), (1, 4), (2, 4), (3, 4))
#: Difference of two bucket codes that lie 0, 1, 2 or 3 quartiles apart.
CODE_DIFFERENCE = (0, 1, 2, 6)
#: Two unrelated digests differ by about this much; differences are bounded by it.
MOST = 13 * BUCKETS // 8

_FACTORS = (0x9E3779B1, 0x85EBCA6B, 0xC2B2AE35, 0x27D4EB2F)


def bucket_counts(data: bytes) -> np.ndarray:
    """How many byte triplets of sliding windows fall into each bucket."""
    padded = np.frombuffer(data + bytes(4), np.uint8).astype(np.uint32)
    count = len(data)
    total = np.zeros(BUCKETS, np.int64)
    first, second, third = (padded * np.uint32(f) for f in _FACTORS[:3])
    for kind, (i, j) in enumerate(TRIPLETS):
        mixed = first[:count] + second[i : i + count]
        mixed += third[j : j + count]
        mixed += np.uint32(kind * 0x1F35 + 1)
        mixed ^= mixed >> np.uint32(15)
        mixed *= np.uint32(_FACTORS[3])
        total += np.bincount(mixed >> np.uint32(24), minlength=BUCKETS)
    return total


def fingerprint(text: str) -> str:
    """Length, checksum, quartile ratios and the quartile of every bucket, in hexadecimal."""
    data = text.encode()
    counts = bucket_counts(data)
    quarter = BUCKETS // 4
    lower, middle, upper = np.sort(counts)[[quarter - 1, 2 * quarter - 1, 3 * quarter - 1]]
    codes = (counts > lower).astype(np.uint8) + (counts > middle) + (counts > upper)
    packed = np.packbits(
        np.stack([codes >> 1, codes & 1], axis=1).astype(np.uint8).reshape(-1)
    ).tobytes()
    length = min(255, int(math.log(len(data) + 1) / math.log(1.5) * 4))
    check = hashlib.blake2b(data, digest_size=1).digest()
    ratios = bytes(int(240 * quartile / max(1, upper)) for quartile in (lower, middle))
    return (bytes([length]) + check + ratios + packed).hex()


def _codes(digest: str) -> tuple[bytes, np.ndarray]:
    raw = bytes.fromhex(digest)
    bits = np.unpackbits(np.frombuffer(raw[4:], np.uint8)).reshape(-1, 2)
    return raw[:4], bits[:, 0] * 2 + bits[:, 1]


def difference(one: str, other: str) -> int:
    """Bounded difference of two fingerprints: 0 for equal ones, at most ``MOST``."""
    (header, codes), (other_header, other_codes) = _codes(one), _codes(other)
    apart = np.abs(codes.astype(np.int8) - other_codes.astype(np.int8))
    score = int(np.array(CODE_DIFFERENCE)[apart].sum())
    score += abs(header[0] - other_header[0])
    score += header[1] != other_header[1]
    score += sum(abs(a - b) // 16 for a, b in zip(header[2:], other_header[2:]))
    return min(score, MOST)


def likeness(one: str, other: str) -> float:
    return 1 - difference(one, other) / MOST


def _edited(text: str, following: str) -> str:
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


_NAMES = [
    "doc_id",
    "n_chars",
    "edited_sha256",
    "fingerprint",
    "edited_fingerprint",
    "near_edited",
    "near_next",
]
_RESULT = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
    "edited_fingerprint string, near_edited double, near_next double"
)
_TYPES = [pa.int64(), pa.int64(), *[pa.string()] * 3, *[pa.float64()] * 2]


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each row against the row behind it; the last of a range is another range's first."""
    current: tuple | None = None
    for batch in batches:
        rows: list[tuple] = []
        columns = [batch.column(c).to_pylist() for c in ("doc_id", "stretch", "copied", "text")]
        for doc_id, stretch, copied, text in zip(*columns):
            digest = fingerprint(text)
            if current and current[1] == stretch:
                rows.append(_row(*current[2:], text, digest))
                if copied:  # only the first copy is behind the last row
                    current = None
            if not copied:
                current = (None, stretch, doc_id, text, digest)
        columns = list(zip(*rows)) or [[]] * len(_NAMES)
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, kind) for c, kind in zip(columns, _TYPES)], _NAMES
        )


def _row(doc_id: int, text: str, digest: str, following: str, following_digest: str) -> tuple:
    edited = _edited(text, following)
    edited_digest = digest if edited == text else fingerprint(edited)
    return (
        doc_id,
        len(text),
        hashlib.sha256(edited.encode()).hexdigest(),
        digest,
        edited_digest,
        likeness(digest, edited_digest),
        likeness(digest, following_digest),
    )


def compare_with_next(
    docs: DataFrame, *, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """Fingerprints of every text, of its edited text, and how near both and the next are.

    The edited text ends with the beginning of the next document in the order of ids, the
    first document being next to the last. Documents are dealt once, to ranges of ids; the
    first document of each range goes to the range before it as well.

    Columns as in ``_RESULT``. A null text is empty. Null ids come first; rows that repeat
    an id follow each other by text. A single document is its own next; an empty table
    gives no rows.
    """
    rows = id_and_text(docs, id_column, text_column)
    bounds = range_bounds(rows, "doc_id", parallelism(docs.sparkSession))
    placed = rows.withColumn("stretch", range_of(F.col("doc_id"), bounds))
    nulls = F.max(F.col("doc_id").isNull())
    heads = placed.groupBy("stretch").agg(F.min("doc_id").alias("first"), nulls.alias("nulls"))
    heads = heads.collect()  # one row for each range
    heads.sort(key=lambda row: row["stretch"])
    number = {row["stretch"]: i for i, row in enumerate(heads)}
    if not heads:
        return rows.limit(0).mapInArrow(_empty, _RESULT)
    firsts = [None if row["nulls"] else row["first"] for row in heads]
    stretch = F.element_at(
        F.lit([number.get(i, 0) for i in range(len(bounds) + 1)]), F.col("stretch") + 1
    )
    first = F.element_at(F.array(*[F.lit(v).cast("long") for v in firsts]), F.col("stretch") + 1)
    own = F.struct(F.col("stretch"), F.lit(False).alias("copied"))
    before = F.struct(
        F.pmod(F.col("stretch") - 1, F.lit(len(heads))).alias("stretch"),
        F.lit(True).alias("copied"),
    )
    places = F.when(F.col("doc_id").eqNullSafe(first), F.array(own, before)).otherwise(F.array(own))
    return (
        placed.withColumn("stretch", stretch)
        .withColumn("place", F.explode(places))
        .select("doc_id", "text", "place.stretch", "place.copied")
        .repartitionById(len(heads), F.col("stretch"))
        .sortWithinPartitions("stretch", "copied", F.col("doc_id").asc_nulls_first(), "text")
        .select("doc_id", "stretch", "copied", "text")
        .mapInArrow(_compare, _RESULT)
    )


def _empty(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for _ in batches:
        yield pa.RecordBatch.from_arrays([pa.array([], kind) for kind in _TYPES], _NAMES)
