"""Benchmark decontamination: windows of test items, broadcast as a hash set, found in documents."""

from __future__ import annotations

import functools
import re
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterlake.llm.common import lists, stage
from meterlake.llm.spans import BLOCK, window_hashes, word_hashes

WINDOW = 10
#: Bytes of normalised item text that are broadcast at a time; their windows take about
#: twelve times as much in a worker. More items are looked up slice by slice.
SLICE_BYTES = 8 << 20
#: Bytes of an item that are kept together; longer items are cut, no window is.
CHUNK_BYTES = 8 << 10
_MOST_FILTER = 1 << 26

_LETTERS, _DIGITS = b"abcdefghijklmnopqrstuvwxyz", b"0123456789"
_IN_WORDS = frozenset([*_LETTERS, *_DIGITS, *range(0x80, 0x100)])
_NORMAL = bytes(byte if byte in _IN_WORDS else 0x20 for byte in bytes(range(256)).lower())
_SPACES = re.compile(rb"  +")
#: A word in a text as it stands, in either case.
_WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def normalised(text: str) -> bytes:
    """The words of a text, A to Z lower-cased, with one space between them."""
    return _SPACES.sub(b" ", text.encode().translate(_NORMAL)).strip()


def segments(data: bytes, size: int, overlap: int) -> Iterator[tuple[bytes, int]]:
    """A normalised text in parts of about ``size`` bytes.

    Every part begins with the last ``overlap`` words of the one before, so that each run of
    ``overlap + 1`` words lies in one part; how many words it repeats comes with it.
    """
    at = again = end = 0
    while True:
        end = data.find(b" ", max(at + size, end + 1)) if len(data) - at > size else -1
        if end < 0:
            yield data[at:], again
            return
        yield data[at:end], again
        back, again = end, 0
        while again < overlap and back >= at:
            back = data.rfind(b" ", at, back)
            again += 1
            if back < 0:
                back = at - 1
        at = back + 1


class Words:
    """The words of several parts of normalised texts, end to end."""

    def __init__(self, parts: Sequence[bytes]) -> None:
        self.data = b"\n".join(parts) + b"\n"
        codes = np.frombuffer(self.data, np.uint8)
        stops = np.flatnonzero((codes == 0x20) | (codes == 0x0A))
        starts = np.concatenate([[0], stops[:-1] + 1])
        some = stops > starts
        self.starts, self.stops = starts[some], stops[some]
        ends = np.cumsum([len(part) + 1 for part in parts])
        self.part = np.searchsorted(ends, self.starts, "right")
        self.hashes = word_hashes(self.data, self.starts, self.stops)

    def windows(self, length: int) -> tuple[np.ndarray, np.ndarray]:
        """First word and hash of every run of ``length`` words of one part."""
        hashes = window_hashes(self.hashes, length)
        first = np.flatnonzero(self.part[: len(hashes)] == self.part[length - 1 :])
        return first, hashes[first]

    def body(self, first: int, length: int) -> bytes:
        return self.data[self.starts[first] : self.stops[first + length - 1]]


class Index:
    """Windows of items by hash: the set that is broadcast. Hits are compared word by word."""

    def __init__(self, items: Sequence[str | None], chunks: Sequence[bytes], window: int) -> None:
        words = Words(chunks)
        counts = np.bincount(words.part, minlength=len(chunks)) if len(chunks) else np.zeros(0, int)
        found = []
        for length in range(1, window + 1):
            first, hashes = words.windows(length)
            own = np.minimum(counts[words.part[first]], window) == length
            first, hashes = first[own], hashes[own]
            last = first + length - 1
            found.append(
                (hashes, words.starts[first], words.stops[last], words.part[first],
                 np.full(len(first), length))
            )
        hashes, starts, stops, chunk, length = map(np.concatenate, zip(*found))
        order = np.argsort(hashes, kind="stable")
        self.lengths = np.unique(length).tolist()
        self.hashes, self._starts, self._stops = hashes[order], starts[order], stops[order]
        self._chunk = chunk[order].astype(np.int32)
        self._items = list(items)
        self._data = words.data
        size = 1 << 12
        while size < min(16 * len(hashes), _MOST_FILTER):
            size *= 2
        self._mask = np.uint64(size - 1)
        self._filter = np.zeros(size, bool)
        self._filter[(hashes & self._mask).astype(np.int64)] = True
        self._known: dict[bytes, frozenset[str | None]] = {}

    def candidates(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which hashes are in the set, and where the first of each stands."""
        some = np.flatnonzero(self._filter[(hashes & self._mask).astype(np.int64)])
        if not (some.size and len(self.hashes)):
            return some[:0], some[:0]
        at = np.minimum(np.searchsorted(self.hashes, hashes[some]), len(self.hashes) - 1)
        hit = self.hashes[at] == hashes[some]
        return some[hit], at[hit]

    def items(self, body: bytes, at: int) -> frozenset[str | None]:
        """The items that have the window ``body``, whose hash stands from ``at`` on."""
        found = self._known.get(body)
        if found is None:
            upto = np.searchsorted(self.hashes, self.hashes[at], "right")
            found = frozenset(
                self._items[self._chunk[i]]
                for i in range(at, upto)
                if self._data[self._starts[i] : self._stops[i]] == body
            )
            self._known[body] = found
        return found


def _chunk_batches(window: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        items: list[str | None] = []
        chunks: list[bytes] = []
        for item, text in zip(*(batch.column(c).to_pylist() for c in ("item", "text"))):
            for part, _ in segments(normalised(text), CHUNK_BYTES, window - 1):
                if part:
                    items.append(item)
                    chunks.append(part)
        yield pa.RecordBatch.from_arrays(
            [pa.array(items, pa.string()), pa.array(chunks, pa.binary())], ["item", "chunk"]
        )


def _indexes(
    benchmark: DataFrame, item_column: str, text_column: str, window: int, slice_bytes: int
) -> Iterator[Broadcast]:
    """The windows of all items, in as many broadcast sets as their bytes ask for."""
    spark = benchmark.sparkSession
    chunks = stage(
        benchmark.select(
            F.col(item_column).cast("string").alias("item"),
            F.coalesce(F.col(text_column).cast("string"), F.lit("")).alias("text"),
        )
        .mapInArrow(functools.partial(_chunk_batches, window), "item string, chunk binary")
        .distinct(),
        "leak_items",
    )
    total = chunks.agg(F.sum(F.octet_length("chunk"))).first()[0] or 0
    slices = max(1, -(-total // slice_bytes))
    for number in range(slices):
        part = chunks.filter(F.pmod(F.xxhash64("item", "chunk"), F.lit(slices)) == number)
        rows = part.collect()  # about ``slice_bytes``, as chunks are dealt evenly by hash
        index = Index([row.item for row in rows], [bytes(row.chunk) for row in rows], window)
        yield spark.sparkContext.broadcast(index)


class _Scan:
    """Hits of one index in the texts of a batch."""

    def __init__(self, index: Index, texts: Sequence[str]) -> None:
        self._index = index
        self.n_words = [0] * len(texts)
        self.spans: list[list[np.ndarray]] = [[] for _ in texts]
        self.items: list[set[str | None]] = [set() for _ in texts]
        overlap = max(index.lengths, default=1) - 1
        rows: list[int] = []
        parts: list[bytes] = []
        repeats: list[int] = []
        size = 0
        for row, text in enumerate(texts):
            for part, again in segments(normalised(text), BLOCK, overlap):
                rows.append(row)
                parts.append(part)
                repeats.append(again)
                size += len(part)
                if size >= BLOCK:
                    self._block(rows, parts, repeats)
                    rows, parts, repeats, size = [], [], [], 0
        if parts:
            self._block(rows, parts, repeats)

    def _block(self, rows: list[int], parts: list[bytes], repeats: list[int]) -> None:
        words = Words(parts)
        counts = np.bincount(words.part, minlength=len(parts))
        first_word = np.cumsum(counts) - counts
        steps = self._hits(words, rows)
        covered = np.cumsum(steps[:-1]) > 0
        for number, (row, again) in enumerate(zip(rows, repeats)):
            begin = self.n_words[row] - again
            self.n_words[row] = begin + int(counts[number])
            own = covered[first_word[number] : first_word[number] + counts[number]]
            if own.any():
                edges = np.flatnonzero(np.diff(own, prepend=False, append=False))
                self.spans[row].append(edges.reshape(-1, 2) + begin)

    def _hits(self, words: Words, rows: list[int]) -> np.ndarray:
        steps = np.zeros(len(words.starts) + 1, np.int64)
        for length in self._index.lengths:
            first, hashes = words.windows(length)
            hits, at = self._index.candidates(hashes)
            for word, place in zip(first[hits].tolist(), at.tolist()):
                items = self._index.items(words.body(word, length), place)
                if items:
                    steps[word] += 1
                    steps[word + length] -= 1
                    self.items[rows[words.part[word]]] |= items
        return steps


def merged(spans: Sequence[np.ndarray]) -> np.ndarray:
    """Spans in order, those that touch joined."""
    every = np.concatenate([np.zeros((0, 2), np.int64), *spans])
    every = every[np.argsort(every[:, 0], kind="stable")]
    reach = np.maximum.accumulate(every[:, 1]) if len(every) else every[:, 1]
    begins = np.flatnonzero(np.concatenate([[True], every[1:, 0] > reach[:-1]])[: len(every)])
    stops = np.append(begins[1:], len(every)) - 1 if len(begins) else begins
    return np.stack([every[begins, 0], reach[stops]], axis=1)


def _scan_batches(
    index: Broadcast, kept: Sequence[str], batches: Iterator[pa.RecordBatch]
) -> Iterator[pa.RecordBatch]:
    """Adds the hits of one index to those that rows have from others."""
    for batch in batches:
        scan = _Scan(index.value, batch.column("text").to_pylist())
        before = [batch.column(c).to_pylist() for c in ("firsts", "lasts", "items")]
        spans, items = [], []
        for new, names, firsts, lasts, others in zip(scan.spans, scan.items, *before):
            old = np.array([firsts, lasts], np.int64).reshape(2, -1).T
            spans.append(merged([*new, old]) if new or firsts else old)
            items.append(sorted({*names, *others} - {None}))
        yield pa.RecordBatch.from_arrays(
            [
                *[batch.column(name) for name in kept],
                pa.array(scan.n_words, pa.int64()),
                lists([s[:, 0] for s in spans], pa.int64()),
                lists([s[:, 1] for s in spans], pa.int64()),
                pa.array(items, pa.list_(pa.string())),
            ],
            [*kept, "n_words", "firsts", "lasts", "items"],
        )


_FOUND = "n_words long, firsts array<long>, lasts array<long>, items array<string>"


def _found(
    rows: DataFrame,
    benchmark: DataFrame,
    keep: dict[str, str],
    *,
    item_column: str,
    item_text_column: str,
    window: int,
    slice_bytes: int,
) -> DataFrame:
    """``rows``, which have ``text``, with their hits; of their columns those in ``keep`` stay."""
    nothing = F.array().cast("array<long>")
    found = rows.select(
        "*",
        nothing.alias("firsts"),
        nothing.alias("lasts"),
        F.array().cast("array<string>").alias("items"),
    )
    indexes = _indexes(benchmark, item_column, item_text_column, window, slice_bytes)
    index = next(indexes)
    every = {**keep, "text": "string"}
    for following in indexes:
        found = stage(_scanned(found, index, every).drop("n_words"), "leaks")
        index = following
    return _scanned(found, index, keep)


def _scanned(rows: DataFrame, index: Broadcast, keep: dict[str, str]) -> DataFrame:
    kept = "".join(f"`{name}` {kind}, " for name, kind in keep.items())
    return rows.mapInArrow(functools.partial(_scan_batches, index, list(keep)), kept + _FOUND)


def _text(text_column: str) -> Column:
    return F.coalesce(F.col(text_column).cast("string"), F.lit("")).alias("text")


def find_leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    *,
    id_column: str = "doc_id",
    text_column: str = "text",
    item_column: str = "item_id",
    item_text_column: str = "text",
    window: int = WINDOW,
    slice_bytes: int = SLICE_BYTES,
) -> DataFrame:
    """One row per document: which of its words stand in windows of benchmark items.

    A word is a run of letters a to z, digits and characters beyond ASCII, with A to Z
    lower-cased first. A window is ``window`` successive words of an item; an item of fewer,
    but some, words is one window. The windows of all items form a hash set that goes to
    every task; documents are scanned where they are read, and each hit of the set is
    compared word by word. The set is built of at most about ``slice_bytes`` of item text:
    a larger benchmark is cut into several, one scan of the documents for each, and the hits
    of one scan are stored with the rows for the next. Nothing is shuffled.

    Columns: doc_id, n_words, firsts and lasts (words covered by windows, as spans from the
    first word to behind the last, in order), items (their ids as sorted strings). A null
    text has no words; null ids of documents stay. Windows of items without an id count, but
    name no item. Repeated documents give repeated rows, repeated items are one item, and
    an empty benchmark hits nothing.
    """
    rows = docs.select(F.col(id_column).cast("long").alias("doc_id"), _text(text_column))
    return _found(
        rows, benchmark, {"doc_id": "long"}, item_column=item_column,
        item_text_column=item_text_column, window=window, slice_bytes=slice_bytes,
    )


def leak_digests(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """``find_leaks`` as counts and a digest: one row per document.

    Columns: doc_id, n_words, n_hit, n_items, items_sha256, contaminated.
    """
    lengths = F.zip_with("lasts", "firsts", lambda last, first: last - first)
    n_hit = F.aggregate(lengths, F.lit(0).cast("long"), lambda total, one: total + one)
    return find_leaks(docs, benchmark, **options).select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )


def cut_words(text: str, firsts: Sequence[int], lasts: Sequence[int]) -> str:
    """A text without some spans of its words, and without what stands between those words."""
    words = [m.span() for m in _WORD.finditer(text)]
    kept, at = [], 0
    for first, last in zip(firsts, lasts):
        kept.append(text[at : words[first][0]])
        at = words[last - 1][1]
    return "".join(kept) + text[at:]


def _cut_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        columns = [batch.column(c).to_pylist() for c in ("text", "firsts", "lasts")]
        left = [cut_words(*row) if row[1] else row[0] for row in zip(*columns)]
        yield pa.RecordBatch.from_arrays(
            [batch.column("row"), batch.column("firsts"), pa.array(left, pa.string())],
            ["row", "firsts", "left"],
        )


def remove_leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    *,
    whole_documents: bool = False,
    text_column: str = "text",
    item_column: str = "item_id",
    item_text_column: str = "text",
    window: int = WINDOW,
    slice_bytes: int = SLICE_BYTES,
) -> DataFrame:
    """``docs`` without the words that stand in benchmark windows, or without such documents.

    All columns stay; rows without hits are unchanged, null texts included. Where a span goes,
    ``n_chars``, if there is one, becomes the length of what is left.
    """
    rows = docs.select(F.struct("*").alias("row"), _text(text_column))
    kind = docs.schema.simpleString()
    found = _found(
        rows, benchmark, {"row": kind, "text": "string"}, item_column=item_column,
        item_text_column=item_text_column, window=window, slice_bytes=slice_bytes,
    )
    if whole_documents:
        return found.filter(F.size("firsts") == 0).select("row.*")
    left = found.mapInArrow(_cut_batches, f"row {kind}, firsts array<long>, left string")
    hit = F.size("firsts") > 0
    changed = {text_column: F.when(hit, F.col("left")).otherwise(F.col(f"row.{text_column}"))}
    if "n_chars" in docs.columns:
        length = F.length("left").cast(docs.schema["n_chars"].dataType)
        changed["n_chars"] = F.when(hit, length).otherwise(F.col("row.n_chars"))
    return left.select(
        *[changed.get(name, F.col(f"row.`{name}`")).alias(name) for name in docs.columns]
    )
