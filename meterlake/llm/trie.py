"""A prefix trie of conversations: which turns they share from the start, and what that saves."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meterlake.llm.common import stage
from meterlake.llm.ordering import numbered

#: Depths of a band: a node adds itself to at most so many ancestors a round.
BAND = 16
#: Ids of one node that are joined to one text at a time.
IDS_TOGETHER = 1_000
#: Parents whose children are more than this, and more than a 1,000th of all nodes, are
#: broadcast: fewer than 1,000 rows.
MOST_CHILDREN = 100

#: A node: its depth, and a hash of 120 bits of the turns up to there.
NODE = ["depth", "high", "low"]
_WORD = r"[^\x20\x09-\x0D]+"
_NO_IDS = hashlib.sha256(b"").hexdigest()


def _turns(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, digest of role and text, and words; texts go no further than here."""
    role = F.coalesce(F.col("role").cast("string"), F.lit(""))
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    both = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    return conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        "turn",
        F.unhex(F.sha2(both, 256)).alias("digest"),
        F.regexp_count(text, F.lit(_WORD)).cast("long").alias("words"),
    ).filter(F.col("conv_id").isNotNull())


def _numbered_turns(conversations: DataFrame) -> DataFrame:
    return stage(
        numbered(_turns(conversations), "conv_id", ["turn", "digest"], "trie_order").select(
            "part", "conv_id", (F.col("place") + 1).alias("depth"), "total", "digest", "words"
        ),
        "trie_turns",
    )


def _members(turns: DataFrame) -> DataFrame:
    return turns.filter(F.col("depth") == 1).select("conv_id", F.col("total").alias("length"))


def _rebuilt(turns: DataFrame, family: int, most_shared: int) -> tuple[DataFrame, DataFrame]:
    """Turns and members (conv_id, length) of conversations with the start of another.

    Conversation c takes the first h turns of conversation c - c % ``family`` for its own first
    h, h being the CRC-32 of the decimal c modulo ``most_shared`` + 1.
    """
    own = _members(turns)
    base = F.col("conv_id") - F.col("conv_id") % family
    heads = (
        turns.filter((F.col("conv_id") % family == 0) & (F.col("depth") <= most_shared))
        .groupBy(F.col("conv_id").alias("base"))
        .agg(F.sort_array(F.collect_list(F.struct("depth", "digest", "words"))).alias("head"))
    )
    shared = F.crc32(F.col("conv_id").cast("string").cast("binary")) % (most_shared + 1)
    known = (
        own.select("conv_id", "length", base.alias("base"), shared.alias("shared"))
        .join(heads, "base", "left")
        .withColumn("head", F.slice(F.coalesce("head", F.array()), 1, F.col("shared").cast("int")))
        .withColumn("taken", F.size("head").cast("long"))
        .withColumn("own", F.greatest(F.col("length") - F.col("shared"), F.lit(0)))
        .select("conv_id", "shared", "head", "taken", (F.col("taken") + F.col("own")).alias("length"))
    )
    known = stage(known, "trie_known")
    taken = known.select(
        F.lit(-1).alias("part"), "conv_id", "length", F.explode("head").alias("turn")
    ).select("part", "conv_id", "turn.depth", "length", "turn.digest", "turn.words")
    parts = turns.groupBy("part", "conv_id").agg(F.count(F.lit(1)).alias("rows")).drop("rows")
    shifts = parts.join(known.drop("head"), "conv_id")
    kept = (
        turns.drop("total")
        .join(shifts, ["part", "conv_id"])
        .filter(F.col("depth") > F.col("shared"))
        .withColumn("depth", F.col("depth") - F.col("shared") + F.col("taken"))
        .select("part", "conv_id", "depth", "length", "digest", "words")
    )
    return taken.unionByName(kept), known.select("conv_id", "length")


def _paths(turns: DataFrame, members: DataFrame) -> DataFrame:
    """The node of every turn of every conversation, its parent, and whether it ends there.

    A node is known by the exclusive or of a hash of each turn with its depth, so the part of
    a conversation before a range of its turns comes in as one value, and no task needs to
    read a long conversation from its start.
    """
    mark = F.sha2(F.concat(F.col("depth").cast("string"), F.lit(":"), F.hex("digest")), 256)

    def number(first: int) -> Column:
        return F.conv(F.substring("mark", first, 15), 16, 10).cast("long")

    marked = stage(
        turns.withColumn("mark", mark)
        .withColumns({"own_high": number(1), "own_low": number(16)})
        .drop("mark", "digest"),
        "trie_marks",
    )
    halves = ("high", "low")
    totals = marked.groupBy("part", "conv_id").agg(
        *[F.bit_xor(f"own_{half}").alias(f"all_{half}") for half in halves]
    )
    earlier = Window.partitionBy("conv_id").orderBy("part").rowsBetween(
        Window.unboundedPreceding, -1
    )
    starts = totals.select(
        "part",
        "conv_id",
        *[
            F.coalesce(F.bit_xor(f"all_{half}").over(earlier), F.lit(0)).alias(f"start_{half}")
            for half in halves
        ],
    )
    so_far = Window.partitionBy("part", "conv_id").orderBy("depth").rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    reached = marked.withColumns(
        {half: F.bit_xor(f"own_{half}").over(so_far) for half in halves}
    ).join(starts, ["part", "conv_id"])
    for half in halves:
        reached = reached.withColumn(half, F.col(half).bitwiseXOR(F.col(f"start_{half}")))
    steps = reached.select(
        "conv_id",
        "depth",
        *halves,
        *[F.col(h).bitwiseXOR(F.col(f"own_{h}")).alias(f"parent_{h}") for h in halves],
        "words",
        (F.col("depth") == F.col("length")).alias("ends"),
    )
    zero, none = F.lit(0).cast("long"), F.lit(None).cast("long")
    roots = members.select(
        "conv_id",
        zero.alias("depth"),
        zero.alias("high"),
        zero.alias("low"),
        none.alias("parent_high"),
        none.alias("parent_low"),
        zero.alias("words"),
        (F.col("length") == 0).alias("ends"),
    )
    return stage(steps.unionByName(roots), "trie_paths")


def _nodes(paths: DataFrame) -> DataFrame:
    """One row per node: its smallest member, members, children, and what to add up."""
    nodes = stage(
        paths.groupBy(*NODE).agg(
            F.min("conv_id").alias("conv_id"),
            F.count(F.lit(1)).alias("n_convs"),
            F.first("parent_high").alias("parent_high"),
            F.first("parent_low").alias("parent_low"),
            F.first("words").alias("words"),
        ),
        "trie_nodes",
    )
    children = (
        nodes.filter(F.col("depth") > 0)
        .groupBy(
            (F.col("depth") - 1).alias("depth"),
            F.col("parent_high").alias("high"),
            F.col("parent_low").alias("low"),
        )
        .agg(F.count(F.lit(1)).alias("n_children"))
    )
    return stage(
        nodes.join(children, NODE, "left")
        .withColumn("n_children", F.coalesce("n_children", F.lit(0)))
        .withColumn("leaves", (F.col("n_children") == 0).cast("long"))
        .withColumn("saved", (F.col("n_convs") - 1) * F.col("words"))
        .drop("words"),
        "trie_values",
    )


def _roll_up(paths: DataFrame, values: DataFrame, band: int) -> DataFrame:
    """Leaves and saved words of whole subtrees, for each node of ``values``.

    Bands are ``band`` depths high. In a first round every node adds its values to its
    ancestors in its band, itself among them; the node at the top of a band then has those
    of its band. The tops of the bands are a trie themselves, with a ``band``-th of the depths,
    and are rolled up the same way. In the last round each completed top adds its totals to
    its ancestors in the band above. So there are as many rounds as the depth has digits, and
    a row explodes to at most ``band`` rows in each.

    The ancestors of a node are read from the turns of its smallest member, which are grouped
    by conversation and band: at most ``band`` rows, however long the conversation.
    """
    number = F.floor(F.col("depth") / band)
    deepest = values.agg(F.max("depth")).first()[0] or 0
    bands = stage(
        paths.groupBy("conv_id", number.alias("band")).agg(
            F.collect_list(F.struct(*NODE)).alias("steps")
        ),
        "trie_bands",
    )

    def added(rows: DataFrame) -> DataFrame:
        return rows.groupBy(*NODE).agg(
            F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved")
        )

    def up(rows: DataFrame, steps: Column) -> DataFrame:
        return rows.join(bands, ["conv_id", "band"]).select(
            F.explode(steps).alias("node"), "leaves", "saved"
        ).select("node.*", "leaves", "saved")

    depth = F.col("depth")
    own = values.select("conv_id", depth.alias("own_depth"), number.alias("band"), "leaves", "saved")
    not_below = F.filter("steps", lambda step: step["depth"] <= F.col("own_depth"))
    in_band = stage(added(up(own, not_below)), "trie_in_band")
    if deepest < band:
        return in_band
    at_top = (depth > 0) & (depth % band == 0)
    tops = values.select("conv_id", *NODE).join(in_band, NODE).filter(depth % band == 0)
    fewer = (depth / band).cast("long")
    totals = _roll_up(
        paths.filter(depth % band == 0).withColumn("depth", fewer),
        tops.withColumn("depth", fewer),
        band,
    ).withColumn("depth", depth * band)
    complete = (
        values.select("conv_id", *NODE)
        .filter(at_top)
        .join(totals, NODE)
        .select("conv_id", (number - 1).alias("band"), "leaves", "saved")
    )
    return stage(added(in_band.unionByName(up(complete, F.col("steps")))), "trie_totals")


def _join_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of rows of one node, in the order of ids, as one row with the ids as text."""
    at: tuple | None = None
    ids: list[int] = []
    names = [*NODE, "first", "ids"]

    def batch(rows: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*rows)) or [[]] * len(names)
        kinds = [pa.int64()] * 4 + [pa.string()]
        return pa.RecordBatch.from_arrays(
            [pa.array(column, kind) for column, kind in zip(columns, kinds)], names
        )

    for given in batches:
        rows: list[tuple] = []
        for *node, conv_id in zip(*(given.column(c).to_pylist() for c in (*NODE, "conv_id"))):
            if ids and (tuple(node) != at or len(ids) == IDS_TOGETHER):
                rows.append((*at, ids[0], ",".join(map(str, ids))))
                ids = []
            at = tuple(node)
            ids.append(conv_id)
        yield batch(rows)
    if ids:
        yield batch([(*at, ids[0], ",".join(map(str, ids)))])


def _hash_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The hash of the joined ids of each node, whose rows follow one another in order."""
    at: tuple | None = None
    state = hashlib.sha256()
    names = [*NODE, "ends_sha256"]

    def batch(rows: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*rows)) or [[]] * len(names)
        kinds = [pa.int64()] * 3 + [pa.string()]
        return pa.RecordBatch.from_arrays(
            [pa.array(column, kind) for column, kind in zip(columns, kinds)], names
        )

    for given in batches:
        rows: list[tuple] = []
        for *node, ids in zip(*(given.column(c).to_pylist() for c in (*NODE, "ids"))):
            if tuple(node) == at:
                state.update(b",")
            else:
                if at is not None:
                    rows.append((*at, state.hexdigest()))
                at, state = tuple(node), hashlib.sha256()
            state.update(ids.encode())
        yield batch(rows)
    if at is not None:
        yield batch([(*at, state.hexdigest())])


def _ends(paths: DataFrame) -> DataFrame:
    """Per node the SHA-256 of the ids that end there.

    Ids are range-sorted, so those of one node are joined to texts by many tasks; only these
    texts meet in one task, which hashes them one after another.
    """
    node = "depth long, high long, low long"
    joined = (
        paths.filter("ends")
        .select(*NODE, "conv_id")
        .repartitionByRange(*NODE, "conv_id")
        .sortWithinPartitions(*NODE, "conv_id")
        .mapInArrow(_join_ids, f"{node}, first long, ids string")
    )
    return (
        joined.repartition(*NODE)
        .sortWithinPartitions(*NODE, "first")
        .mapInArrow(_hash_ids, f"{node}, ends_sha256 string")
    )


def _parents(values: DataFrame) -> DataFrame:
    """Per node below the root the smallest member of its parent.

    Parents of very many children are few; they are broadcast, and no key of the other join
    has more rows than ``MOST_CHILDREN`` or a 1,000th of the nodes.
    """
    least = max(MOST_CHILDREN, values.count() // 1000)
    parent = [F.col("depth").alias("above"), "high", "low", F.col("conv_id").alias("parent_conv_id")]
    below = values.filter(F.col("depth") > 0).select(
        *NODE,
        (F.col("depth") - 1).alias("above"),
        F.col("parent_high"),
        F.col("parent_low"),
    )

    def keyed(rows: DataFrame) -> DataFrame:
        return rows.select(*parent).withColumnsRenamed({"high": "parent_high", "low": "parent_low"})

    key = ["above", "parent_high", "parent_low"]
    many = keyed(values.filter(F.col("n_children") > least))
    few = keyed(values.filter(F.col("n_children").between(1, least)))
    tried = below.join(F.broadcast(many), key, "left")
    found = tried.filter(F.col("parent_conv_id").isNotNull())
    others = tried.filter(F.col("parent_conv_id").isNull()).drop("parent_conv_id").join(few, key)
    return found.unionByName(others).select(*NODE, "parent_conv_id")


def _trie(turns: DataFrame, members: DataFrame, band: int) -> DataFrame:
    paths = _paths(turns, members)
    values = _nodes(paths)
    totals = _roll_up(
        paths.select("conv_id", *NODE), values.select("conv_id", *NODE, "leaves", "saved"), band
    )
    return (
        values.drop("leaves", "saved", "parent_high", "parent_low")
        .join(totals, NODE)
        .join(_ends(paths), NODE, "left")
        .join(_parents(values), NODE, "left")
        .select(
            "conv_id",
            "depth",
            "parent_conv_id",
            "n_convs",
            "n_children",
            F.col("leaves").alias("n_leaves"),
            F.col("saved").alias("saved_tokens"),
            F.coalesce("ends_sha256", F.lit(_NO_IDS)).alias("ends_sha256"),
        )
    )


def prefix_trie(conversations: DataFrame, *, band: int = BAND) -> DataFrame:
    """One row per distinct start of conversations: a node, from the root of no turns.

    ``conversations`` has a row per turn: conv_id, turn, role, text. Turns go by ``turn``, null
    first; turns of one number go by a digest of role and text. Null role or text is empty.
    Two conversations share a node of depth d if their first d turns are equal.

    Columns: conv_id (smallest member) and depth, which name the node; parent_conv_id (with
    depth - 1 the parent; null for the root), n_convs (members), n_children, n_leaves
    (childless nodes below, or the node itself), saved_tokens (over the subtree: words of a
    node's last text times its members but one), ends_sha256 (of the sorted ids of the members
    that end there). Rows without a conv_id belong to no conversation; repeated rows are turns
    of their own; an empty table has no nodes. Nodes are told apart by hashes of 120 bits.
    """
    turns = _numbered_turns(conversations)
    return _trie(
        turns.withColumnRenamed("total", "length"), _members(turns), band
    )


def shared_prefix_trie(
    conversations: DataFrame, *, family: int = 20, most_shared: int = 3, band: int = BAND
) -> DataFrame:
    """``prefix_trie`` after each conversation took over the start of one of its family.

    Conversation c begins with the first h original turns of conversation c - c % ``family``
    (all if there are fewer, none if there is no such conversation), then come its own turns
    after its first h; h is the CRC-32 of the decimal c modulo ``most_shared`` + 1. One that is
    left without turns is a member of the root alone.
    """
    turns = _numbered_turns(conversations)
    return _trie(*_rebuilt(turns, family, most_shared), band)
