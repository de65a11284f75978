"""Long passages that repeat across documents: a sparse de Bruijn graph of their words."""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterlake.llm.common import id_and_text, lists, stage
from meterlake.llm.spans import WordHasher, window_hashes

WINDOW = 50


def edge_words(window: int) -> int:
    """Words of a token k-mer; a window then has at most as many k-mers as a k-mer words."""
    return window // 2 + 1


class _Document:
    """The k-mers of a document's words, and which of them stands for each window.

    A window's edge is its k-mer with the smallest hash. Where that hash occurs more than
    once in a window, no place is singled out.
    """

    def __init__(self, words: np.ndarray, window: int) -> None:
        self.words, self.window, self.size = words, window, edge_words(window)
        self.edges = window_hashes(words, self.size)
        if len(words) < window:
            self.place = np.zeros(0, np.int64)
            self.tied = np.zeros(0, bool)
            return
        seen = np.lib.stride_tricks.sliding_window_view(self.edges, window - self.size + 1)
        steps = np.arange(len(seen))
        self.place = seen.argmin(axis=1) + steps
        last = seen[:, ::-1].argmin(axis=1)
        self.tied = self.place != steps + seen.shape[1] - 1 - last

    def window_hashes(self) -> np.ndarray:
        return window_hashes(self.words, self.window)

    def seeds(self) -> tuple[np.ndarray, np.ndarray]:
        """Hash and place of the edges that stand for windows; place -1 where tied."""
        places = np.unique(self.place[~self.tied])
        tied = np.unique(self.edges[self.place[self.tied]])
        hashes = np.concatenate([self.edges[places], tied]).view(np.int64)
        return hashes, np.concatenate([places, np.full(len(tied), -1)]).astype(np.int32)


def _seed_batches(window: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    words = WordHasher()
    for batch in batches:
        texts = batch.column("text").to_pylist()
        counts, digests, edges, places = [], [], [], []
        for text, hashes in zip(texts, words(texts)):
            found = _Document(hashes, window).seeds()
            counts.append(len(hashes))
            digests.append(hashlib.sha256(b" ".join(text.encode().split())).hexdigest())
            edges.append(found[0])
            places.append(found[1])
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"),
                batch.column("key"),
                pa.array(counts, pa.int64()),
                pa.array(digests, pa.string()),
                lists(edges, pa.int64()),
                lists(places, pa.int32()),
            ],
            ["doc_id", "key", "n_words", "all_sha256", "edges", "places"],
        )


def _verify_batches(window: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Spans that whole paths settle, and hashes of the windows that need a look."""
    words = WordHasher()
    for batch in batches:
        texts = batch.column("text").to_pylist()
        firsts, lasts, open_windows = [], [], []
        rows = zip(batch.column("doc_id").to_pylist(), batch.column("found"), words(texts))
        for doc_id, found, hashes in rows:
            document = _Document(hashes, window)
            settled, windows = _settle(document, doc_id, found.values)
            firsts.append(settled[:, 0])
            lasts.append(settled[:, 1])
            open_windows.append(windows)
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"),
                batch.column("key"),
                batch.column("text"),
                lists(firsts, pa.int32()),
                lists(lasts, pa.int32()),
                lists(open_windows, pa.int64()),
            ],
            ["doc_id", "key", "text", "firsts", "lasts", "windows"],
        )


def _settle(
    document: _Document, doc_id: int | None, found: pa.StructArray
) -> tuple[np.ndarray, np.ndarray]:
    """Follow nonbranching paths: spans of whole paths of an earlier document, open windows."""
    column = {name: found.field(name).to_numpy(zero_copy_only=False) for name in
              ("place", "edge", "first", "onward", "backward")}
    places, chosen = np.unique(column["place"], return_index=True)
    chosen = chosen[places >= 0]
    places = places[places >= 0].astype(np.int64)
    size, window = document.size, document.window
    onward, backward = column["onward"][chosen], column["backward"][chosen]
    gap = np.diff(places)
    joined = onward[:-1] & backward[1:] & (gap <= window - size + 1)
    begins = np.flatnonzero(np.concatenate([[True], ~joined])) if len(places) else places
    path = np.cumsum(np.concatenate([[1], ~joined]))[: len(places)] - 1
    stops = np.append(begins[1:], len(places)) - 1 if len(places) else begins
    start, end = places[begins], places[stops] + size
    first = column["first"][chosen][begins] if len(places) else np.zeros(0, np.int64)
    earlier = np.ones(len(first), bool) if doc_id is None else first < doc_id
    whole = earlier & (end - start >= window)
    settled = np.stack([start[whole], end[whole]], axis=1).astype(np.int32)

    known = np.isin(document.edges[document.place].view(np.int64), column["edge"])
    at = np.searchsorted(places, document.place)
    at = np.minimum(at, max(0, len(places) - 1))
    steps = np.arange(len(document.place))
    if len(places):
        on_path = ~document.tied & (places[at] == document.place)
        inside = on_path & (start[path[at]] <= steps) & (steps + window <= end[path[at]])
    else:
        inside = np.zeros(len(steps), bool)
    open_places = np.flatnonzero(known & ~inside)
    if not open_places.size:
        return settled, np.zeros(0, np.int64)
    return settled, np.unique(document.window_hashes()[open_places]).view(np.int64)


def _remove_batches(window: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    words = WordHasher()
    for batch in batches:
        removed, digests = [], []
        columns = [batch.column(c) for c in ("firsts", "lasts", "repeated")]
        texts = batch.column("text").to_pylist()
        for text, hashes, firsts, lasts, repeated in zip(texts, words(texts), *columns):
            step = np.zeros(len(hashes) + 1, np.int32)
            np.add.at(step, firsts.values.to_numpy(), 1)
            np.add.at(step, lasts.values.to_numpy(), -1)
            if repeated.is_valid and len(repeated.values):
                every = window_hashes(hashes, window).view(np.int64)
                at = np.flatnonzero(np.isin(every, repeated.values.to_numpy()))
                np.add.at(step, at, 1)
                np.add.at(step, at + window, -1)
            kept = np.cumsum(step[:-1]) == 0
            tokens = text.encode().split()
            left = b" ".join(tokens[i] for i in np.flatnonzero(kept).tolist())
            removed.append(len(tokens) - int(kept.sum()))
            digests.append(hashlib.sha256(left).hexdigest())
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("key"), pa.array(removed, pa.int64()),
             pa.array(digests, pa.string())],
            ["doc_id", "key", "n_removed", "kept_sha256"],
        )


def _edges(seeds: DataFrame, **more: Column) -> DataFrame:
    """One row per edge that stands for windows, with what ``more`` has for each."""
    columns = {"edge": F.col("edges"), "place": F.col("places"), **more}
    zipped = F.arrays_zip(*[column.alias(name) for name, column in columns.items()])
    rows = seeds.filter(F.size("edges") > 0)
    return rows.select("doc_id", "key", F.explode(zipped).alias("seed")).select(
        "doc_id", "key", "seed.*"
    )


def _neighbours() -> dict[str, Column]:
    """The edges around each edge of a document and their places, 0 at the ends."""

    def after(name: str, kind: str) -> Column:
        return F.concat(F.slice(name, 2, F.size(name)), F.array(F.lit(0).cast(kind)))

    def before(name: str, kind: str) -> Column:
        return F.concat(F.array(F.lit(0).cast(kind)), F.slice(name, 1, F.size(name) - 1))

    return {
        "after": after("edges", "long"),
        "after_place": after("places", "int"),
        "before": before("edges", "long"),
        "before_place": before("places", "int"),
    }


def _linked(edges: DataFrame, most_gap: int) -> DataFrame:
    """The next and the previous edge of each, 0 where there is none within reach."""

    def link(edge: str, gap: Column, far: Column) -> Column:
        near = (F.col("place") >= 0) & (far >= 0) & (gap > 0) & (gap <= most_gap)
        return F.when(near, F.xxhash64(F.col(edge), gap)).otherwise(F.lit(0).cast("long"))

    after, before = F.col("after_place"), F.col("before_place")
    return edges.select(
        "doc_id",
        "edge",
        link("after", after - F.col("place"), after).alias("next"),
        link("before", F.col("place") - before, before).alias("last"),
    )


def _crosses() -> Column:
    """Rows of several documents: an earlier one and a later one, or one without an id."""
    return (F.col("first") < F.col("latest")) | (F.col("first").isNotNull() & F.col("unnamed"))


def _by_document() -> list[Column]:
    return [
        F.min("doc_id").alias("first"),
        F.max("doc_id").alias("latest"),
        F.max(F.col("doc_id").isNull()).alias("unnamed"),
    ]


def remove_repeats(
    docs: DataFrame,
    *,
    id_column: str = "doc_id",
    text_column: str = "text",
    window: int = WINDOW,
) -> DataFrame:
    """One row per document: how many words are left without repeated windows.

    A word goes if it is covered by ``window`` successive words that also start in a
    document with a smaller id. Token k-mers are the edges of a de Bruijn graph, kept
    sparse: each window is represented by its k-mer with the smallest hash, so equal
    windows share an edge. Grouping finds the edges of several documents and those that
    are always followed, and always preceded, by the same edge; such edges form
    nonbranching paths, which stand whole in every document that has a part of them, and a
    path settles all its windows at once. Windows that a path does not hold whole, at its
    ends and around branches, are verified by the words at their source: their hashes meet
    in a second grouping.

    Columns: doc_id, n_words, n_removed, kept_sha256. A null text has no words, texts
    shorter than a window lose none. Null ids count as later than all others and do not
    repeat each other; rows that repeat an id do not repeat each other either. An empty
    table gives no rows. Equality is that of 64-bit hashes of whole k-mers and windows.
    """
    size = edge_words(window)
    rows = id_and_text(docs, id_column, text_column).withColumn("key", F.xxhash64("text"))
    seeds = stage(
        rows.mapInArrow(
            functools.partial(_seed_batches, window),
            "doc_id long, key long, n_words long, all_sha256 string, "
            "edges array<long>, places array<int>",
        ),
        "repeat_edges",
    )
    linked = _linked(_edges(seeds, **_neighbours()), window - size + 1)

    def always(name: str) -> Column:
        return (F.min(name) == F.max(name)) & (F.min(name) != 0)

    shared = stage(
        linked.groupBy("edge")
        .agg(*_by_document(), always("next").alias("onward"), always("last").alias("backward"))
        .filter(_crosses())
        .select("edge", "first", "onward", "backward"),
        "repeat_shared",
    )
    found = (
        _edges(seeds)
        .join(shared, "edge")
        .groupBy("doc_id", "key")
        .agg(
            F.collect_list(F.struct("place", "edge", "first", "onward", "backward")).alias("found")
        )
        .withColumnsRenamed({"doc_id": "found_id", "key": "found_key"})
    )
    same = F.col("doc_id").eqNullSafe(F.col("found_id")) & (F.col("key") == F.col("found_key"))
    settled = stage(
        rows.join(found, same)
        .select("doc_id", "key", "text", "found")
        .mapInArrow(
            functools.partial(_verify_batches, window),
            "doc_id long, key long, text string, firsts array<int>, lasts array<int>, "
            "windows array<long>",
        ),
        "repeat_settled",
    )
    windows = settled.select("doc_id", "key", F.explode("windows").alias("window"))
    again = windows.groupBy("window").agg(*_by_document()).filter(_crosses())
    later = (
        windows.join(stage(again.select("window", "first"), "repeat_windows"), "window")
        .filter(F.coalesce(F.col("first") < F.col("doc_id"), F.lit(True)))
        .groupBy("doc_id", "key")
        .agg(F.collect_list("window").alias("repeated"))
        .withColumnsRenamed({"doc_id": "found_id", "key": "found_key"})
    )
    removed = (
        settled.join(later, same, "left")
        .filter((F.size("firsts") > 0) | F.col("repeated").isNotNull())
        .select("doc_id", "key", "text", "firsts", "lasts", "repeated")
        .mapInArrow(
            functools.partial(_remove_batches, window),
            "doc_id long, key long, n_removed long, kept_sha256 string",
        )
        .groupBy(F.col("doc_id").alias("found_id"), F.col("key").alias("found_key"))
        .agg(F.first("n_removed").alias("n_removed"), F.first("kept_sha256").alias("kept_sha256"))
    )
    return (
        seeds.select("doc_id", "key", "n_words", "all_sha256")
        .join(removed, same, "left")
        .select(
            "doc_id",
            "n_words",
            F.coalesce("n_removed", F.lit(0).cast("long")).alias("n_removed"),
            F.coalesce("kept_sha256", "all_sha256").alias("kept_sha256"),
        )
    )
