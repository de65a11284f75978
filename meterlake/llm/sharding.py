"""Shards of equal size that keep linked documents together: balanced label propagation."""

from __future__ import annotations

from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meterlake.llm.common import id_and_text, parallelism, stage

#: Share by which a shard may be too large while documents still move.
SLACK = 0.02
#: Movers to a shard are admitted in this many steps.
STEPS = 64
#: The documents of a group move in parts of this share of a shard.
PART = 1 / 16


def shard_documents(
    docs: DataFrame,
    *,
    shards: int = 16,
    id_column: str = "doc_id",
    text_column: str = "text",
    rounds: int | None = None,
) -> DataFrame:
    """Every document in one of ``shards``, counts at most one apart, equal texts together.

    Documents start in a shard drawn from their id. In each round the documents linked by
    an equal text move towards the open shard where most of them already are, as far as
    quotas admit them; quotas come from counts per shard and step, a table of fixed size. A
    shard that had to refuse some is closed to later rounds, so a group larger than a shard
    fills one after another. Documents without links may always make room: what exceeds a
    shard's share in the end, those first, fills shards that have room, so that counts
    differ by one at most. ``rounds`` end early when nothing moves any more; there are as
    many as shards, and a few, unless given.

    Columns: doc_id, size (UTF-8 bytes of the text plus one), text_crc32, law (``rows``),
    shard, slot (gapless from 0 in each shard), grown_shard (null under this law),
    group_size (documents with that text). A null text counts 1 byte and equals an empty
    one; null ids and repeated rows are placed like any other; an empty table gives no rows.
    """
    nodes = stage(
        id_and_text(docs, id_column, text_column).select(
            "doc_id",
            (F.octet_length("text") + 1).cast("long").alias("size"),
            F.crc32(F.col("text").cast("binary")).alias("text_crc32"),
            F.unhex(F.sha2("text", 256)).alias("sha"),
        ),
        "shard_nodes",
    )
    total = nodes.count()
    room = -(-total // shards)
    linked, single = _links(nodes, max(1, int(room * PART)))
    start = F.pmod(F.xxhash64("doc_id", "text_crc32"), F.lit(shards)).cast("int")
    single = single.withColumn("shard", start)
    linked = stage(linked.withColumn("shard", start), "shard_labels")
    closed: set[int] = set()
    for number in range(shards + 4 if rounds is None else rounds):
        moved, linked = _propagate(linked, closed, room, shards, number)
        if not moved:
            break
    return _level(linked.unionByName(single), total, shards)


def _links(nodes: DataFrame, most: int) -> tuple[DataFrame, DataFrame]:
    """Documents with an equal partner, by group and part of it; and the others.

    A group stands for the links of its members with each other. Parts have about ``most``
    documents.
    """
    groups = stage(
        nodes.groupBy("sha").agg(F.count(F.lit(1)).alias("group_size")).filter("group_size > 1"),
        "shard_groups",
    )
    parts = F.ceil(F.col("group_size") / most)
    group = F.when(F.col("group_size").isNotNull(), F.xxhash64("sha"))
    rows = (
        nodes.join(groups, "sha", "left")
        .withColumn("group", group)
        .withColumn("unit", F.xxhash64("group", F.pmod(F.xxhash64("doc_id"), parts)))
        .drop("sha")
    )
    rows = stage(rows, "shard_units")
    return rows.filter("group IS NOT NULL"), rows.filter("group IS NULL")


def _propagate(
    linked: DataFrame, closed: set[int], room: int, shards: int, number: int
) -> tuple[int, DataFrame]:
    """One round: moves made, and the new labels; shards that refuse some are closed."""
    is_open = ~F.col("shard").isin(sorted(closed)) if closed else F.lit(True)
    wishes = (
        linked.filter(is_open)
        .groupBy("group", "shard")
        .agg(F.count(F.lit(1)).alias("members"))
        .groupBy("group")
        .agg(F.max_by("shard", F.struct("members", F.xxhash64("group", "shard"))).alias("wish"))
    )
    stays = F.col("wish").isNull() | ((F.col("group_size") > room) & ~is_open)
    step = F.pmod(F.xxhash64("unit", F.lit(number)), F.lit(STEPS)).cast("int")
    wanted = stage(
        linked.join(wishes, "group", "left")
        .withColumn("wish", F.when(stays, F.col("shard")).otherwise(F.col("wish")))
        .withColumn("step", step),
        "shard_wishes",
    )
    flows = np.zeros((shards, shards, STEPS), np.int64)
    for row in wanted.groupBy("shard", "wish", "step").count().collect():  # flows.size at most
        flows[row["shard"], row["wish"], row["step"]] = row["count"]
    admitted = _quotas(flows, int(room * (1 + SLACK)))
    closed.update(shard for shard in range(shards) if admitted[shard] < STEPS)
    moved = sum(
        int(flows[:, to, : admitted[to]].sum() - flows[to, to, : admitted[to]].sum())
        for to in range(shards)
    )
    limit = F.element_at(F.lit(admitted), F.col("wish") + 1)
    labels = F.when(F.col("step") < limit, F.col("wish")).otherwise(F.col("shard"))
    return moved, wanted.withColumn("shard", labels).drop("wish", "step")


def _quotas(flows: np.ndarray, most: int) -> list[int]:
    """Per shard, the steps whose movers it admits, so that none grows beyond ``most``."""
    shards = len(flows)
    admitted = [STEPS] * shards
    steps = np.arange(STEPS)
    while True:
        goes = steps[None, :] < np.array(admitted)[:, None]
        coming = (flows * goes[None]).sum(axis=2)
        staying = (flows * ~goes[None]).sum(axis=(1, 2))
        sizes = coming.sum(axis=0) + staying
        new = coming.sum(axis=0) - coming.diagonal()
        over = np.where(new > 0, sizes - most, 0)
        if over.max() <= 0:
            return admitted
        admitted[int(over.argmax())] -= 1


def _level(rows: DataFrame, total: int, shards: int) -> DataFrame:
    """Exact counts and gapless slots; what exceeds a shard's target fills the others."""
    place = F.when(
        F.col("group").isNotNull(), F.pmod(F.col("unit"), F.lit(1 << 20)) / (1 << 20)
    ).otherwise(1 + F.pmod(F.xxhash64("doc_id", "text_crc32"), F.lit(1 << 20)) / (1 << 20))
    stretches = max(2, parallelism(rows.sparkSession))
    rows = rows.withColumn("place", place).withColumn(
        "stretch", F.floor(F.col("place") * stretches / 2).cast("int")
    )
    rows = stage(rows, "shard_places")
    sizes = rows.groupBy("shard", "stretch").agg(F.count(F.lit(1)).alias("rows")).collect()
    counts, before = [0] * shards, []  # at most shards * stretches rows
    for row in sorted(sizes, key=lambda r: (r["shard"], r["stretch"])):
        before.append((row["shard"], row["stretch"], counts[row["shard"]]))
        counts[row["shard"]] += row["rows"]
    offsets = rows.sparkSession.createDataFrame(
        before, "shard int, stretch int, before long"
    )
    targets = [total // shards + (s < total % shards) for s in range(shards)]
    order = Window.partitionBy("shard", "stretch").orderBy(
        "place", "unit", "doc_id", "text_crc32", "size"
    )
    ranked = (
        rows.withColumn("number", F.row_number().over(order))
        .join(F.broadcast(offsets), ["shard", "stretch"])
        .withColumn("rank", F.col("before") + F.col("number") - 1)
    )
    target = F.element_at(F.lit(targets), F.col("shard") + 1)
    spare = [max(0, c - t) for c, t in zip(counts, targets)]
    spare_before = [sum(spare[:s]) for s in range(shards)]
    ranked = ranked.withColumn(
        "waiting",
        F.when(
            F.col("rank") >= target,
            F.element_at(F.lit(spare_before), F.col("shard") + 1) + F.col("rank") - target,
        ),
    )
    return ranked.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        _seat(counts, targets, F.col("shard"), lambda s, first, have: F.lit(s)).alias("shard"),
        _seat(
            counts, targets, F.col("rank"), lambda s, first, have: F.col("waiting") - first + have
        ).cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
    )


def _seat(counts: list[int], targets: list[int], staying: Column, moving) -> Column:
    """A value for documents that stay, and one for those that wait for a free seat."""
    cases, first = [], 0
    for shard, (have, target) in enumerate(zip(counts, targets)):
        free = max(0, target - have)
        if free:
            waits = (F.col("waiting") >= first) & (F.col("waiting") < first + free)
            cases.append((waits, moving(shard, first, have)))
            first += free
    return reduce(lambda rest, case: F.when(case[0], case[1]).otherwise(rest), cases, staying)
