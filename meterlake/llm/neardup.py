"""Near-duplicate documents: banded DartMinHash signatures, verified word by word."""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterlake.llm.common import id_and_text, lists, stage
from meterlake.llm.components import components
from meterlake.llm.darts import signature
from meterlake.llm.spans import WordHasher, mixed, window_hashes

SHINGLE = 5
SIMILARITY = 0.8
#: At the similarity above, a pair shares no band with a probability of 2 in a million.
BANDS, ROWS = 25, 4
#: Texts compared with one center in one stretch of work; a center with more is copied.
STRETCH = 256

#: Nodes of a bucket that one task holds at a time, and shingles of them.
BLOCK_NODES, BLOCK_SHINGLES = 512, 1_000_000

_SIGNED = "doc_id long, key long, node binary, size int, bands array<long>"


def shingles(words: np.ndarray, length: int) -> np.ndarray:
    """The distinct shingles of a text, sorted; a shorter text is one shingle."""
    if not len(words):
        return np.zeros(0, np.uint64)
    return np.unique(window_hashes(words, min(length, len(words))))


def _bands(darts: np.ndarray, bands: int, rows: int) -> np.ndarray:
    hashes = np.arange(1, bands + 1, dtype=np.uint64)
    for row in range(rows):
        hashes = mixed(hashes ^ darts.reshape(bands, rows)[:, row])
    return hashes.view(np.int64)


def _sign(
    length: int, bands: int, rows: int, batches: Iterator[pa.RecordBatch]
) -> Iterator[pa.RecordBatch]:
    words = WordHasher()
    for batch in batches:
        nodes, sizes, keys = [], [], []
        nothing = np.zeros(0, np.int64)
        texts = batch.column("text").to_pylist()
        for hashes in words(texts):
            elements = shingles(hashes, length)
            nodes.append(hashlib.blake2b(elements.tobytes(), digest_size=16).digest())
            sizes.append(len(elements))
            darts = signature(elements, bands * rows)
            keys.append(_bands(darts, bands, rows) if len(elements) else nothing)
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"),
                batch.column("key"),
                pa.array(nodes, pa.binary()),
                pa.array(sizes, pa.int32()),
                lists(keys, pa.int64()),
            ],
            ["doc_id", "key", "node", "size", "bands"],
        )


def _verify(
    length: int, similarity: float, batches: Iterator[pa.RecordBatch]
) -> Iterator[pa.RecordBatch]:
    """Pairs of a center, which comes first, and the texts behind it that are similar."""
    words = WordHasher()
    center: bytes | None = None
    elements = np.zeros(0, np.uint64)
    for batch in batches:
        texts = batch.column("text").to_pylist()
        rows = zip(batch.column("a").to_pylist(), batch.column("b").to_pylist(), words(texts))
        found: list[tuple[bytes, bytes]] = []
        for a, b, hashes in rows:
            these = shingles(hashes, length)
            if b is None:
                center, elements = a, these
                continue
            assert a == center
            shared = len(np.intersect1d(elements, these, assume_unique=True))
            if shared >= similarity * (len(elements) + len(these) - shared):
                found.append((a, b))
        columns = list(zip(*found)) or [[], []]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.binary()) for c in columns], ["a", "b"])


def _similar(pairs: DataFrame, texts: DataFrame, length: int, similarity: float) -> DataFrame:
    """The pairs of nodes whose texts are similar; a center's text goes to each stretch once."""
    counts = pairs.groupBy("a").agg(F.ceil(F.count(F.lit(1)) / STRETCH).alias("stretches"))
    dealt = pairs.join(counts, "a").select(
        "a", "b", F.pmod(F.xxhash64("b"), F.col("stretches")).alias("stretch")
    )
    members = dealt.join(texts.withColumnRenamed("node", "b"), "b").select(
        "a", "stretch", "b", "text"
    )
    centers = (
        dealt.select("a", "stretch")
        .distinct()
        .join(texts.withColumnRenamed("node", "a"), "a")
        .select("a", "stretch", F.lit(None).cast("binary").alias("b"), "text")
    )
    return (
        members.unionByName(centers)
        .repartition("a", "stretch")
        .sortWithinPartitions("a", "stretch", F.col("b").asc_nulls_first())
        .select("a", "b", "text")
        .mapInArrow(functools.partial(_verify, length, similarity), "a binary, b binary")
    )


def near_duplicates(
    docs: DataFrame,
    *,
    id_column: str = "doc_id",
    text_column: str = "text",
    shingle: int = SHINGLE,
    similarity: float = SIMILARITY,
    bands: int = BANDS,
    rows: int = ROWS,
) -> DataFrame:
    """One row per document with the class of texts it is linked to.

    Two texts are linked if the sets of their word shingles have a Jaccard similarity of
    ``similarity`` or more; classes are the connected components. Texts with equal sets are
    one node, so copies are never compared. Nodes whose DartMinHash signatures agree in a
    band share a bucket. In each bucket every node is compared with the least node there;
    the links make first components. Buckets that still hold several are compared block by
    block: a task holds the words of a bounded number of nodes in an inverted index and
    looks up the others one by one, giving one link per node and component it reaches. So
    pairs are neither listed nor shuffled, links within a component are not looked for
    again, and none between components is left out. Every comparison is exact.

    Columns: doc_id, class_id (the least id of the class, null if it has none), class_size,
    node (hexadecimal; equal for equal sets). A null text is empty; texts without words are
    one class; a text shorter than a shingle is a single shingle. Repeated rows are one
    node; null ids are classed like any other. An empty table gives no rows.
    """
    found = _classes(docs, id_column, text_column, shingle, similarity, bands, rows)
    return found.select(
        "doc_id", "class_id", "class_size", F.lower(F.hex("node")).alias("node")
    )


def _classes(
    docs: DataFrame,
    id_column: str,
    text_column: str,
    shingle: int,
    similarity: float,
    bands: int,
    rows: int,
) -> DataFrame:
    texts = id_and_text(docs, id_column, text_column).withColumn("key", F.xxhash64("text"))
    signed = stage(
        texts.mapInArrow(functools.partial(_sign, shingle, bands, rows), _SIGNED),
        "darts_signed",
    )
    nodes = signed.groupBy("node").agg(
        F.first(F.struct("doc_id", "key", "size", "bands")).alias("one")
    )
    nodes = stage(nodes.select("node", "one.*"), "darts_nodes")
    places = nodes.select("node", "size", F.explode("bands").alias("bucket"))
    buckets = places.groupBy("bucket").agg(
        F.min(F.struct("node", "size")).alias("least"), F.count(F.lit(1)).alias("nodes")
    )
    shared = stage(buckets.filter("nodes > 1").select("bucket", "least"), "darts_buckets")
    members = stage(places.join(shared, "bucket"), "darts_members")

    def compatible(one: str, other: str):
        return F.least(one, other) >= similarity * F.greatest(one, other)

    first = (
        members.filter(
            (F.col("node") != F.col("least.node")) & compatible("size", "least.size")
        )
        .select(F.col("least.node").alias("a"), F.col("node").alias("b"))
        .distinct()
    )
    first = stage(first, "darts_pairs")
    wanted = (
        members.select("node")
        .distinct()
        .join(nodes.select("node", "doc_id", "key"), "node")
        .withColumnsRenamed({"doc_id": "wanted_id", "key": "wanted_key"})
    )
    same = F.col("doc_id").eqNullSafe(F.col("wanted_id")) & (F.col("key") == F.col("wanted_key"))
    bodies = stage(
        texts.join(wanted, same).groupBy("node").agg(F.first("text").alias("text")), "darts_texts"
    )
    links = stage(_similar(first, bodies, shingle, similarity), "darts_links")
    classes = components(links)
    between = stage(
        _between(members, classes, bodies, shingle, similarity), "darts_between"
    )
    if not between.isEmpty():
        classes = components(links.unionByName(between))
    named = signed.select("doc_id", "key", "node").join(classes, "node", "left")
    named = named.withColumn("root", F.coalesce("root", "node"))
    sizes = named.groupBy("root").agg(
        F.count(F.lit(1)).alias("class_size"),
        F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "key")).alias("least"),
    )
    least = F.col("least")
    return named.join(stage(sizes, "darts_classes"), "root").select(
        "doc_id",
        "key",
        "node",
        "class_size",
        least["doc_id"].alias("class_id"),
        (F.col("doc_id").eqNullSafe(least["doc_id"]) & (F.col("key") == least["key"])).alias(
            "kept"
        ),
    )


def _between(
    members: DataFrame, classes: DataFrame, bodies: DataFrame, length: int, similarity: float
) -> DataFrame:
    """Links between different components within buckets that hold several.

    The nodes of a bucket are dealt into blocks. Each block meets its own nodes and those of
    later blocks, so every pair of the bucket meets once.
    """
    named = (
        members.select("bucket", "node", "size")
        .join(classes, "node", "left")
        .withColumn("root", F.coalesce("root", "node"))
    )
    blocks = F.greatest(
        F.ceil(F.count(F.lit(1)) / BLOCK_NODES), F.ceil(F.sum("size") / BLOCK_SHINGLES)
    )
    several = named.groupBy("bucket").agg(
        blocks.cast("int").alias("blocks"),
        F.min("root").alias("least_root"),
        F.max("root").alias("last_root"),
    )
    several = several.filter("least_root != last_root").select("bucket", "blocks")
    block = F.pmod(F.xxhash64("node", "bucket"), F.col("blocks")).cast("int")
    rows = named.join(several, "bucket").withColumn("own", block)
    dealt = rows.select(
        "bucket", "node", "root", "own", F.explode(F.sequence(F.lit(0), F.col("own"))).alias("block")
    )
    return (
        dealt.join(bodies, "node")
        .withColumn("looks_up", F.col("own") != F.col("block"))
        .repartition("bucket", "block")
        .sortWithinPartitions("bucket", "block", "looks_up", "node")
        .select("bucket", "block", "looks_up", "node", "root", "text")
        .mapInArrow(functools.partial(_cross, length, similarity), "a binary, b binary")
        .distinct()
    )


def _cross(
    length: int, similarity: float, batches: Iterator[pa.RecordBatch]
) -> Iterator[pa.RecordBatch]:
    """Links within a block, and of later nodes with it; its own nodes come first."""
    words = WordHasher()
    block: _Block | None = None
    for batch in batches:
        columns = [batch.column(c).to_pylist() for c in ("bucket", "block", "looks_up")]
        names = zip(batch.column("node").to_pylist(), batch.column("root").to_pylist())
        texts = batch.column("text").to_pylist()
        found: list[tuple[bytes, bytes]] = []
        for *place, later, (node, root), hashes in zip(*columns, names, words(texts)):
            if block is None or block.place != place:
                if block:
                    found += block.inner_links()
                block = _Block(place, similarity)
            elements = shingles(hashes, length)
            if later:
                found += block.links(node, root, elements)
            else:
                block.add(node, root, elements)
        yield _pairs(found)
    if block:
        yield _pairs(block.inner_links())


def _pairs(found: list[tuple[bytes, bytes]]) -> pa.RecordBatch:
    columns = list(zip(*found)) or [[], []]
    return pa.RecordBatch.from_arrays([pa.array(c, pa.binary()) for c in columns], ["a", "b"])


class _Block:
    """Nodes of one bucket in an inverted index of their shingles."""

    def __init__(self, place: list, similarity: float) -> None:
        self.place = place
        self._similarity = similarity
        self._nodes: list[tuple[bytes, bytes]] = []
        self._elements: list[np.ndarray] = []
        self._index: tuple[np.ndarray, ...] | None = None
        self._joined: dict[bytes, bytes] = {}

    def add(self, node: bytes, root: bytes, elements: np.ndarray) -> None:
        self._nodes.append((node, root))
        self._elements.append(elements)

    def inner_links(self) -> list[tuple[bytes, bytes]]:
        return [
            link
            for (node, root), elements in zip(self._nodes, self._elements)
            for link in self.links(node, root, elements)
        ]

    def links(self, node: bytes, root: bytes, elements: np.ndarray) -> list[tuple[bytes, bytes]]:
        """Links of a node that join components of this block, or itself to one of them.

        What earlier links joined counts as one component, so there are no more links than
        nodes that were looked up or held.
        """
        if self._index is None:
            self._index = self._build()
            self._joined = {root: root for _, root in self._nodes}
        shingle, starts, owners, sizes = self._index
        at = np.minimum(np.searchsorted(shingle, elements), max(0, len(shingle) - 1))
        at = at[shingle[at] == elements] if len(shingle) else at[:0]
        counts = starts[at + 1] - starts[at]
        ends = np.cumsum(counts)
        if not len(ends):
            return []
        places = np.repeat(starts[at] - (ends - counts), counts) + np.arange(ends[-1])
        shared = np.bincount(owners[places], minlength=len(sizes))
        similar = shared >= self._similarity * (sizes + len(elements) - shared)
        own = self._find(root) if root in self._joined else None
        reached: dict[bytes, bytes] = {}
        for i in np.flatnonzero(similar).tolist():
            other, other_root = self._nodes[i]
            joined = self._find(other_root)
            if joined != own:
                reached.setdefault(joined, other)
        for joined in reached:
            own = joined if own is None else own
            self._joined[joined] = own
        return [(min(node, other), max(node, other)) for other in reached.values()]

    def _find(self, root: bytes) -> bytes:
        while self._joined[root] != root:
            self._joined[root] = self._joined[self._joined[root]]
            root = self._joined[root]
        return root

    def _build(self) -> tuple[np.ndarray, ...]:
        sizes = np.array([len(e) for e in self._elements], np.int64)
        flat = np.concatenate(self._elements) if len(sizes) else np.zeros(0, np.uint64)
        owners = np.repeat(np.arange(len(sizes)), sizes)
        order = np.argsort(flat, kind="stable")
        shingle, starts = np.unique(flat[order], return_index=True)
        return shingle, np.append(starts, len(flat)), owners[order], sizes


def keep_one(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` with one document of each class, that with the least id.

    All columns stay as they were. Rows are found again by id and text; of rows that repeat
    both one stays, and null ids stay only in classes that have no other.
    """
    decided = _classes(docs, "doc_id", "text", SHINGLE, SIMILARITY, BANDS, ROWS).filter("kept")
    decided = decided.select(F.col("doc_id").alias("kept_id"), F.col("key").alias("kept_key"))
    rows = docs.select(
        F.struct("*").alias("row"),
        F.col("doc_id").cast("long").alias("id"),
        F.xxhash64(F.coalesce("text", F.lit(""))).alias("key"),
    )
    same = F.col("id").eqNullSafe(F.col("kept_id")) & (F.col("key") == F.col("kept_key"))
    return (
        rows.join(decided, same, "left_semi")
        .groupBy("id", "key")
        .agg(F.first("row").alias("row"))
        .select("row.*")
    )
