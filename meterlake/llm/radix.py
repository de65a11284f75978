"""Exact duplicates by most-significant-byte-first radix partitioning."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterlake.llm.common import SPACES, id_and_text, stage

FIRST_BYTES = 64
#: Few rounds keep the text moved small: each round carries what is left of open texts.
GROWTH = 64


def exact_groups(
    docs: DataFrame,
    *,
    id_column: str = "doc_id",
    text_column: str = "text",
    first_bytes: int = FIRST_BYTES,
) -> DataFrame:
    """One row per document: the document that stays for its text, and the group's size.

    Texts are compared after each run of white space became one space. A group of
    documents that agree so far is split by its next successive bytes, a few at first
    and ``GROWTH`` times as far each round, until it is a single document or its texts
    have ended. Bytes themselves are compared, never a digest; ``text_sha256`` is only
    reported. Rows of a group meet in counts combined before the shuffle, and only
    documents still in a group of several are carried to the next round.

    Columns: doc_id, keep_id, group_size, kept, text_sha256. A null text is the empty
    text, and empty texts are one group. The smallest doc_id of a group stays; null ids
    stay only where the group has no other. Of rows that repeat both id and text one
    stays. An empty table gives no rows; other columns are ignored.
    """
    text = F.regexp_replace("text", SPACES, " ")
    active = id_and_text(docs, id_column, text_column).select(
        "doc_id",
        F.unhex(F.sha2(text, 256)).alias("sha"),
        F.lit(0).cast("long").alias("part"),
        text.cast("binary").alias("rest"),
    )
    finished: list[DataFrame] = []
    upto, width = 0, first_bytes
    while True:
        split = _split(active, width)
        finished.append(split.filter("done").drop("done", "part", "rest"))
        active = split.filter("not done").select("doc_id", "sha", "part", "rest")
        if active.isEmpty():
            break
        upto += width
        width = upto * (GROWTH - 1)
    return _decide(reduce(DataFrame.unionByName, finished))


def _split(active: DataFrame, width: int) -> DataFrame:
    """Split each part by its next ``width`` bytes; stored, with what is left of each text."""
    rows = active.withColumns(
        {
            "bytes": F.substring("rest", 1, width),
            "ended": F.octet_length("rest") <= width,
        }
    )
    keys = ["part", "bytes", "ended"]
    shared = stage(
        rows.groupBy(*keys)
        .agg(F.min("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
        .filter("group_size > 1")
        .withColumn("next_part", F.monotonically_increasing_id()),
        "radix_parts",
    )
    done = F.col("group_size").isNull() | F.col("ended")
    # A merge join at any size: a hot part is split among tasks, and the plan stays the same.
    joined = rows.join(shared.hint("merge"), keys, "left").select(
        "doc_id",
        "sha",
        F.coalesce("keep_id", F.when(F.col("group_size").isNull(), F.col("doc_id"))).alias(
            "keep_id"
        ),
        F.coalesce("group_size", F.lit(1).cast("long")).alias("group_size"),
        done.alias("done"),
        F.col("next_part").alias("part"),
        F.when(~done, F.expr(f"substring(rest, {width + 1})")).alias("rest"),
        F.monotonically_increasing_id().alias("row"),
    )
    return stage(joined, "radix_rows")


def _decide(groups: DataFrame) -> DataFrame:
    """``kept`` for one row of each group, also where rows repeat id and text."""
    candidate = F.col("doc_id").eqNullSafe(F.col("keep_id"))
    repeated = (
        groups.filter((F.col("group_size") > 1) & candidate)
        .groupBy(F.col("doc_id").alias("again_id"), F.col("sha").alias("again_sha"))
        .agg(F.count(F.lit(1)).alias("rows"), F.min("row").alias("first_row"))
        .filter("rows > 1")
    )
    same = F.col("doc_id").eqNullSafe(F.col("again_id")) & (F.col("sha") == F.col("again_sha"))
    return groups.join(repeated, same, "left").select(
        "doc_id",
        "keep_id",
        "group_size",
        (candidate & (F.col("first_row").isNull() | (F.col("row") == F.col("first_row")))).alias(
            "kept"
        ),
        F.lower(F.hex("sha")).alias("text_sha256"),
    )


def keep_first(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` without exact copies, all columns as they were.

    Rows are found again by id and text; of rows that repeat both, one stays.
    """
    sha = F.sha2(F.regexp_replace(F.coalesce("text", F.lit("")), SPACES, " "), 256)
    decided = exact_groups(docs).filter("kept").select("doc_id", "text_sha256")
    rows = docs.select(
        F.struct("*").alias("row"), F.col("doc_id").cast("long").alias("id"), sha.alias("sha")
    )
    same = rows["id"].eqNullSafe(decided["doc_id"]) & (rows["sha"] == decided["text_sha256"])
    return (
        rows.join(decided, same, "left_semi")
        .groupBy("id", "sha")
        .agg(F.first("row").alias("row"))
        .select("row.*")
    )
