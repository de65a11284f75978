"""A Merkle manifest of a dataset: every row can be checked against one hash."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meterlake.llm.common import stage
from meterlake.llm.ordering import numbered

#: Levels of a tree that one pass over windows climbs; a window has at most two to that many rows.
LEVELS = 8
#: What a leaf hashes, in order, and the mark of a null.
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
NULL = "-"
#: How a proof writes a sibling to the left, one to the right, and that there is none.
LEFT, RIGHT, ALONE = "<", ">", "="


def _field(value: Column) -> Column:
    text = value.cast("string")
    written = F.concat(F.octet_length(text).cast("string"), F.lit(":"), text)
    return F.coalesce(written, F.lit(NULL))


def leaf_hash(fields: dict[str, Column]) -> Column:
    """The hash of one row: each field as its length in UTF-8 bytes and its value."""
    return F.sha2(F.concat(*[_field(fields[name]) for name in FIELDS]), 256)


def _climb(nodes: DataFrame) -> DataFrame:
    """``LEVELS`` levels over nodes (tree, place, total, node), in windows of aligned blocks.

    Every row keeps the hash of its own ancestor. The sibling of an ancestor at a level stands
    one run of rows behind or ahead: lag and lead by that fixed offset, masked by the slot of
    the row and by how far the tree reaches. Only the last run of a tree may be shorter than
    the offset; its hash is then that of the last row of the block. The first row of a run
    hashes the parent, the others of the run take it from there.

    Adds ``block``, the place of the top; ``node`` becomes the top, ``proof`` the siblings.
    """
    block = Window.partitionBy("tree", "block").orderBy("place")
    whole = block.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    so_far = block.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    place, total, node = F.col("place"), F.col("total"), F.col("node")
    rows = nodes.withColumn("block", F.shiftright(place, LEVELS)).withColumn(
        "proof", F.array().cast("array<string>")
    )
    for level in range(LEVELS):
        run = 1 << level
        several = total > run
        on_the_right = F.shiftright(place, level).bitwiseAND(F.lit(1)) == 1
        first = place - place.bitwiseAND(F.lit(run - 1))
        sibling = F.when(
            on_the_right, F.concat(F.lit(LEFT), F.col("behind"))
        ).when(
            first + run < total,
            F.concat(F.lit(RIGHT), F.coalesce(F.col("ahead"), F.col("end"))),
        )
        opens = place.bitwiseAND(F.lit(2 * run - 1)) == 0
        parent = F.sha2(F.concat(node, F.coalesce(F.substring(F.col("sibling"), 2, 64), F.lit(""))), 256)
        rows = (
            rows.withColumns(
                {
                    "behind": F.lag("node", run).over(block),
                    "ahead": F.lead("node", run).over(block),
                    "end": F.last("node").over(whole),
                }
            )
            .withColumn("sibling", sibling)
            .withColumn("parent", F.when(opens & several, parent))
            .withColumn("above", F.last("parent", ignorenulls=True).over(so_far))
            .withColumns(
                {
                    "node": F.when(several, F.col("above")).otherwise(node),
                    "proof": F.when(
                        several,
                        F.concat("proof", F.array(F.coalesce("sibling", F.lit(ALONE)))),
                    ).otherwise(F.col("proof")),
                }
            )
            .drop("behind", "ahead", "end", "sibling", "parent", "above")
        )
    return rows


def _tops(done: DataFrame) -> DataFrame:
    """The nodes that the next pass climbs on from."""
    return done.filter(F.col("place") == F.shiftleft(F.col("block"), LEVELS)).select(
        "tree",
        F.col("block").alias("place"),
        F.shiftright(F.col("total") + F.lit((1 << LEVELS) - 1), LEVELS).alias("total"),
        "node",
    )


def _passes(nodes: DataFrame, label: str) -> list[DataFrame]:
    """Stored passes up to the roots; each takes the tops of the one before."""
    done = [stage(_climb(nodes), f"{label}_0")]
    largest = done[0].agg(F.max("total")).first()[0] or 0
    while largest > 1 << LEVELS:
        done.append(stage(_climb(_tops(done[-1])), f"{label}_{len(done)}"))
        largest = -(-largest >> LEVELS)
    return done


def _descend(passes: list[DataFrame], above: DataFrame) -> DataFrame:
    """Rows of the first pass with what ``above`` has for each root, and whole proofs.

    ``above`` has tree, block (0), rest (the proof above the root) and any other columns. A
    row of a pass finds those of its top by a join in which at most a block of rows meets.
    """
    for done in reversed(passes[1:]):
        above = (
            done.select("tree", "place", "block", "proof")
            .join(above, ["tree", "block"])
            .withColumn("rest", F.concat("proof", "rest"))
            .drop("block", "proof")
            .withColumnRenamed("place", "block")
        )
    return (
        passes[0]
        .drop("node")
        .join(above, ["tree", "block"])
        .withColumn("proof", F.concat("proof", "rest"))
        .drop("rest")
    )


def fold(leaf: Column, proof: Column) -> Column:
    """The root that a leaf and its proof lead to."""

    def step(node: Column, entry: Column) -> Column:
        sibling = F.substring(entry, 2, 64)
        left = F.when(F.startswith(entry, F.lit(LEFT)), sibling).otherwise(F.lit(""))
        right = F.when(F.startswith(entry, F.lit(RIGHT)), sibling).otherwise(F.lit(""))
        return F.sha2(F.concat(left, node, right), 256)

    return F.aggregate(proof, leaf, step)


def build_manifest(leaves: DataFrame) -> DataFrame:
    """``leaves`` (doc_id, lang, leaf and any others) with ``subroot``, ``root``, ``proof``.

    Per lang, leaves in the order of their id are hashed two by two, level by level, an odd
    last one alone, up to a subroot; subroots, in the order of their lang, null first, make
    a tree of their own. ``proof`` lists the siblings from the leaf to the root as text:
    "<" or ">" for left or right and the hash, or "=" where there is none.

    A pass climbs eight levels in windows of at most 256 rows, so a lang with most rows is
    spread over all tasks; passes go on over the tops, a 256th of the rows each time. Null
    ids come first, rows with one id in the order of their leaves; equal rows are leaves of
    their own. No rows make no tree.
    """
    named = leaves.withColumn(
        "tree", F.coalesce(F.concat(F.lit("="), F.col("lang")), F.lit(NULL))
    ).drop("lang")
    placed = numbered(named, "tree", ["doc_id", "leaf"], "manifest_leaves")
    own = _passes(placed.drop("part").withColumn("node", F.col("leaf")), "manifest")
    roots = _tops(own[-1]).select("tree", F.col("node").alias("subroot"))
    all_trees = roots.select(
        F.lit("").alias("all"), F.col("tree").alias("lang_tree"), "subroot"
    )
    placed_roots = numbered(all_trees, "all", ["lang_tree"], "manifest_roots").select(
        F.col("all").alias("tree"),
        "place",
        "total",
        F.col("subroot").alias("node"),
        "lang_tree",
        "subroot",
    )
    upper = _passes(placed_roots, "manifest_top")
    root = _tops(upper[-1]).select(
        "tree",
        F.lit(0).cast("long").alias("block"),
        F.array().cast("array<string>").alias("rest"),
        F.col("node").alias("root"),
    )
    above = stage(
        _descend(upper, root).select(
            F.col("lang_tree").alias("tree"),
            F.lit(0).cast("long").alias("block"),
            F.col("proof").alias("rest"),
            "subroot",
            "root",
        ),
        "manifest_above",
    )
    return _descend(own, above).drop("tree", "block", "place", "total")


def _fields(id_column: str, text_column: str) -> dict[str, Column]:
    given = {**{name: name for name in FIELDS}, "doc_id": id_column, "text": text_column}
    return {name: F.col(column) for name, column in given.items()}


def document_leaves(
    docs: DataFrame, *, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """doc_id, lang and leaf of every row of a table with the columns of documents."""
    fields = _fields(id_column, text_column)
    return docs.select(
        fields["doc_id"].cast("long").alias("doc_id"),
        fields["lang"].cast("string").alias("lang"),
        leaf_hash(fields).alias("leaf"),
    )


def manifest_check(
    docs: DataFrame, *, id_column: str = "doc_id", text_column: str = "text", every: int = 7
) -> DataFrame:
    """The manifest of ``docs``, and which rows still lead to its root after tampering.

    Tampering adds one to n_chars where ``every`` divides the CRC-32 of the decimal id; a null
    id or a null n_chars stays. The changed leaf is folded with the siblings of the manifest.

    Columns: doc_id, leaf, subroot, root, proof_sha256, folded_root, verified.
    """
    fields = _fields(id_column, text_column)
    chosen = F.crc32(fields["doc_id"].cast("string").cast("binary")) % every == 0
    more = fields["n_chars"].cast("decimal(20,0)") + 1
    changed = leaf_hash({**fields, "n_chars": more})
    leaf = leaf_hash(fields)
    leaves = docs.select(
        fields["doc_id"].cast("long").alias("doc_id"),
        fields["lang"].cast("string").alias("lang"),
        leaf.alias("leaf"),
        F.when(chosen & fields["n_chars"].isNotNull(), changed).alias("changed"),
    )
    siblings = F.transform("proof", lambda entry: F.substring(entry, 2, 64))
    return (
        build_manifest(leaves)
        .withColumn("folded_root", fold(F.coalesce("changed", "leaf"), F.col("proof")))
        .select(
            "doc_id",
            "leaf",
            "subroot",
            "root",
            F.sha2(F.array_join(siblings, ""), 256).alias("proof_sha256"),
            "folded_root",
            (F.col("folded_root") == F.col("root")).alias("verified"),
        )
    )
