"""A Merkle manifest of a dataset, built by pivoting slots.

Every row of a table is a leaf. The leaves of a group, in the order of their ids, are the
lowest level of a tree; a parent has up to ``fanout`` consecutive children, and conditional
aggregates spread their hashes over one column for each slot. All columns put together give
the parent's hash; all but a child's own give the child's siblings. The groups' roots are
the leaves of one more tree, whose root stands for the whole table.

- Leaves are numbered without gathering a group: rows are sorted in ranges of (group, id),
  numbered within their range, and moved by the number of rows that the ranges before hold.
- Each level is one aggregate on (group, number of the parent), a third of the level below.
- Proofs are handed down from the root: the children of a node get its siblings with their
  own put in front. That joins on (group, number of the parent), level by level.

The manifest keeps the siblings as an array, level by level, of the hashes left and right
of the own slot, so a changed leaf can be folded up to the root again.

A null is hashed as ``-``, and a null group or id is a group or an id like others, before
all others. Rows with one id in one group follow each other by their hash. Empty texts
differ from null. Rows repeated whole are leaves of their own. Only the given columns
count; extra ones are ignored. An empty table has no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from obslake.llm.common import stored

#: Bits that Spark keeps for a row's number within its partition, in the numbers it gives.
_WITHIN = 33

_STEP = "struct<left:string,right:string>"


def leaf_hash(columns: list[str | Column]) -> Column:
    """The hash of a row: each value as its length in bytes, a colon and the value."""
    fields = []
    for column in columns:
        text = (F.col(column) if isinstance(column, str) else column).cast("string")
        shown = F.concat(F.octet_length(text).cast("string"), F.lit(":"), text)
        fields.append(F.coalesce(shown, F.lit("-")))
    return F.sha2(F.concat(*fields), 256)


def numbered(rows: DataFrame, group: str, order: list[str], purpose: str) -> DataFrame:
    """Rows with ``pos``, their number from 0 in their group, and ``n``, the group's rows.

    ``group`` must not be null. No task sees more than one range of rows; what is summed up
    in windows is a row for each group and range.
    """
    spark = rows.sparkSession
    parts = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    mark = F.monotonically_increasing_id()
    ranged = stored(
        rows.repartitionByRange(parts, group, *order)
        .sortWithinPartitions(group, *order)
        .withColumn("mark", mark),
        purpose,
    )
    part = F.shiftright("mark", _WITHIN).alias("part")
    counts = ranged.groupBy(F.col(group).alias("of_group"), part).agg(
        F.min("mark").alias("first_mark"), F.count(F.lit(1)).alias("rows")
    )
    ranges = W.partitionBy("of_group").orderBy("part")
    earlier = F.sum("rows").over(ranges.rowsBetween(W.unboundedPreceding, -1))
    starts = counts.select(
        "of_group",
        F.col("part").alias("of_part"),
        (F.coalesce(earlier, F.lit(0)) - F.col("first_mark")).alias("shift"),
        F.sum("rows").over(W.partitionBy("of_group")).alias("n"),
    )
    here = (F.col(group) == F.col("of_group")) & (
        F.shiftright("mark", _WITHIN) == F.col("of_part")
    )
    return (
        ranged.join(starts, here)
        .withColumn("pos", F.col("mark") + F.col("shift"))
        .drop("mark", "shift", "of_group", "of_part")
    )


def _slots(fanout: int) -> list[str]:
    return [f"slot{k}" for k in range(fanout)]


def parents(nodes: DataFrame, fanout: int) -> DataFrame:
    """The level above: (grp, pos, n, a column for each slot, hash) from (grp, pos, n, hash)."""
    slot = F.col("pos") % fanout
    spread = [
        F.max(F.when(slot == k, F.col("hash"))).alias(name) for k, name in enumerate(_slots(fanout))
    ]
    return (
        nodes.groupBy("grp", F.floor(F.col("pos") / fanout).alias("above"))
        .agg(*spread, F.max("n").alias("below"))
        .select(
            "grp",
            F.col("above").alias("pos"),
            F.ceil(F.col("below") / fanout).alias("n"),
            *_slots(fanout),
            F.sha2(F.concat_ws("", *_slots(fanout)), 256).alias("hash"),
        )
    )


def grow(leaves: DataFrame, fanout: int, purpose: str) -> list[DataFrame]:
    """The levels of all groups' trees from the one above the leaves up, each a table.

    A group is in a level as long as more than one node of it is left.
    """
    levels: list[DataFrame] = []
    nodes = leaves.select("grp", "pos", "n", "hash")
    most = nodes.agg(F.max("n")).first()[0] or 0
    while most > 1:
        levels.append(stored(parents(nodes.where("n > 1"), fanout), f"{purpose}-level"))
        nodes = levels[-1].select("grp", "pos", "n", "hash")
        most = -(-most // fanout)
    return levels


def roots(leaves: DataFrame, levels: list[DataFrame]) -> DataFrame:
    """(grp, root): the only node left of each group."""
    tops = [frame.where("n = 1").select("grp", F.col("hash").alias("root")) for frame in levels]
    found = leaves.where("n = 1").select("grp", F.col("hash").alias("root"))
    for top in tops:
        found = found.unionAll(top)
    return found


def _siblings(k: int, fanout: int) -> Column:
    """What stands left and right of slot k."""
    names = _slots(fanout)
    return F.struct(
        F.concat_ws("", *names[:k], F.lit("")).alias("left"),
        F.concat_ws("", *names[k + 1 :], F.lit("")).alias("right"),
    )


def hand_down(levels: list[DataFrame], fanout: int, above: DataFrame, purpose: str) -> DataFrame:
    """(grp, pos, path) of every leaf: the siblings on its way to its group's root, and then
    ``path`` of ``above`` (grp, path), what the group's root has on its way further up.
    Further columns of ``above`` are handed down as they are."""
    carried = [name for name in above.columns if name not in ("grp", "path")]
    paths: DataFrame | None = None
    for level in reversed(levels):
        # Groups that end at this level start with what their root has above it.
        top = level.where("n = 1").select("grp", "pos", *_slots(fanout)).join(above, "grp")
        if paths is not None:
            inner = level.where("n > 1").select("grp", "pos", *_slots(fanout))
            top = top.unionByName(inner.join(paths, ["grp", "pos"]))
        children = F.array(
            *[
                F.when(
                    F.col(name).isNotNull(),
                    F.struct(
                        (F.col("pos") * fanout + k).alias("pos"),
                        F.concat(F.array(_siblings(k, fanout)), "path").alias("path"),
                    ),
                )
                for k, name in enumerate(_slots(fanout))
            ]
        )
        child = F.explode(F.array_compact(children)).alias("child")
        handed = top.select("grp", *carried, child).select("grp", *carried, "child.*")
        paths = stored(handed, f"{purpose}-paths")
    return paths


def proofs(leaves: DataFrame, levels: list[DataFrame], fanout: int, above: DataFrame, purpose: str):
    """(grp, pos, path) of every leaf, also of those that are alone in their group."""
    alone = leaves.where("n = 1").select("grp", "pos").join(above, "grp")
    if not levels:
        return alone
    return alone.unionByName(hand_down(levels, fanout, above, purpose))


def fold(leaf: Column, path: Column) -> Column:
    """The root that a leaf gives with the siblings of its path."""
    up = lambda own, step: F.sha2(F.concat(step["left"], own, step["right"]), 256)
    return F.aggregate(path, leaf, up)


def proof_text(path: Column) -> Column:
    """All siblings of a path, level by level, left to right."""
    return F.array_join(F.transform(path, lambda step: F.concat(step["left"], step["right"])), "")


def manifest(
    rows: DataFrame,
    *,
    group: str = "source",
    order: str = "doc_id",
    columns: tuple[str | Column, ...] = ("doc_id", "source", "lang", "n_chars", "text"),
    fanout: int = 3,
    keep: dict[str, Column] | None = None,
) -> DataFrame:
    """One row for each row of the table: its group and id (``order``) under their names,
    leaf, subroot, root, path, and the columns of ``keep``.

    Texts are hashed where they are read; only hashes are shuffled.
    """
    if {group, order} & {"grp", "pos", "n", "hash", "path", "leaf", "subroot", "root"}:
        raise ValueError("group and order must not bear a name of the manifest's own")
    kept = list(keep or {})
    # Null comes first, then names by their bytes; and the name is never null.
    name = F.coalesce(F.concat(F.lit("="), F.col(group).cast("string")), F.lit("-"))
    leaves = stored(
        rows.select(
            name.alias("grp"),
            F.col(group).alias("group_value"),
            F.col(order).alias("order_value"),
            leaf_hash(list(columns)).alias("hash"),
            *[column.alias(f"keep_{k}") for k, column in (keep or {}).items()],
        ),
        "leaves",
    )
    leaves = stored(numbered(leaves, "grp", ["order_value", "hash"], "ranges"), "numbered")
    levels = grow(leaves, fanout, "group")
    subroots = roots(leaves, levels)

    tops = subroots.select("grp", F.col("root").alias("hash"), F.lit("all").alias("whole"))
    tops = stored(numbered(tops, "whole", ["grp"], "group-ranges"), "groups")
    upper_leaves = tops.select(F.col("whole").alias("grp"), "pos", "n", "hash")
    upper = grow(upper_leaves, fanout, "top")
    summit = roots(upper_leaves, upper).select("root")
    nothing = upper_leaves.where("pos = 0").select(
        "grp", F.array().cast(f"array<{_STEP}>").alias("path")
    )
    ways = proofs(upper_leaves, upper, fanout, nothing, "top").select("pos", "path")
    # A row for each group, with the groups' siblings and the root of all.
    groups = stored(
        tops.select("grp", "pos", F.col("hash").alias("subroot"))
        .join(ways, "pos")
        .withColumn("root", summit.scalar())
        .select("grp", "subroot", "root", "path"),
        "group-facts",
    )
    paths = proofs(leaves, levels, fanout, groups, "group")
    return leaves.join(paths, ["grp", "pos"]).select(
        F.col("group_value").alias(group),
        F.col("order_value").alias(order),
        F.col("hash").alias("leaf"),
        "subroot",
        "root",
        "path",
        *[F.col(f"keep_{k}").alias(k) for k in kept],
    )
