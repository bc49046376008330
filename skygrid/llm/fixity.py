"""Fixity audit of web archives by hash trees.

Each record is hashed over its named columns. Records are ordered by their offset; a
node of level L covers the offsets with one value of offset div fanout ** L (towards zero, so that all
meet in node 0), and its
hash is that of its children's numbers and hashes in order. Two replicas whose roots
agree agree throughout, and nothing but the roots is compared. Where they differ, only children of differing nodes
are read, down to the records.

A tree has one table (node, hash) for each level, ordered by node, so that the ranges of nodes that an audit
descends to are few row groups of the files. While at most ``listed`` nodes differ, their
children's ranges are a filter of the scan; beyond, a join finds the children. A node has less than twice fanout
children; records that share one offset are combined by sums before that, whatever their number.

Defined cases
- columns null: hashed apart from empty text; offset null: counts as -1
- repeated rows: the leaf holds their number, so a lost copy shows as changed
- an empty replica: no root; all records of the other are missing or extra
- both empty: no rows; columns that are not named aren't looked at
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import discard, written

#: Hex digits in each part of a hash that is summed; four parts.
LANE = 15


def record_hash(columns: Sequence[str]) -> Column:
    """sha256 of the columns, each with its length in characters before it."""
    fields = [F.coalesce(F.concat(F.length(F.col(c).cast("string")).cast("string"), F.lit(":"), F.col(c).cast("string")), F.lit("-")) for c in columns]
    return F.sha2(F.concat(*fields), 256)


def leaves(records: DataFrame, offset: str, columns: Sequence[str]) -> DataFrame:
    """node (the offset), hash (of how many records are there, and sums over their hashes)."""
    hashed = records.select(F.coalesce(F.col(offset).cast("long"), F.lit(-1)).alias("node"), record_hash(columns).alias("h"))
    sums = [F.sum(F.conv(F.substring("h", 1 + k * LANE, LANE), 16, 10).cast("decimal(20,0)")).cast("string") for k in range(4)]
    return hashed.groupBy("node").agg(F.sha2(F.concat_ws("|", F.count("*").cast("string"), F.min("h"), F.max("h"), *sums), 256).alias("hash"))


def tree(records: DataFrame, offset: str, columns: Sequence[str], fanout: int = 64) -> list[DataFrame]:
    """The levels, from the records' (node, hash) to the root's."""

    def placed(level: DataFrame) -> DataFrame:
        return written(level.repartitionByRange("node").sortWithinPartitions("node"))

    levels = [placed(leaves(records, offset, columns))]
    while len(levels) == 1 or levels[-1].limit(2).count() > 1:
        children = F.array_sort(F.collect_list(F.struct("node", "hash")))
        text = F.concat_ws(",", F.transform(children, lambda c: F.concat(c["node"].cast("string"), F.lit(":"), c["hash"])))
        levels.append(placed(levels[-1].groupBy(F.expr(f"node div {fanout}").alias("node")).agg(F.sha2(text, 256).alias("hash"))))
    return levels


def ranges_below(nodes: list[int], fanout: int) -> list[tuple[int, int]]:
    """First and last of the children of nodes, ranges that touch as one."""
    out: list[tuple[int, int]] = []
    for n in sorted(nodes):
        a, b = (n * fanout - (fanout - 1 if n <= 0 else 0), n * fanout + (fanout - 1 if n >= 0 else 0))
        if out and a <= out[-1][1] + 1:
            out[-1] = (out[-1][0], b)
        else:
            out.append((a, b))
    return out


def audit(left: list[DataFrame], right: list[DataFrame], fanout: int = 64, listed: int = 256) -> DataFrame:
    """offset, status of the records that differ: "changed", "missing" (from right) or "extra" (in right)."""
    # The smaller tree's root stands below: comparing begins at the level that both have.
    top, differ = min(len(left), len(right)) - 1, None
    for k in range(top, -1, -1):
        suspects = [] if differ is None else [r[0] for r in differ.select("node").limit(listed + 1).collect()]
        if differ is not None and not suspects:
            break
        a, b = left[k].withColumnRenamed("hash", "a"), right[k].withColumnRenamed("hash", "b")
        if suspects:
            if len(suspects) <= listed:
                near = reduce(or_, [F.col("node").between(x, y) for x, y in ranges_below(suspects, fanout)])
                a, b = a.where(near), b.where(near)
            else:
                up = differ.select(F.col("node").alias("up"))
                a, b = (x.withColumn("up", F.expr(f"node div {fanout}")).join(up, "up", "left_semi").drop("up") for x in (a, b))
        found = written(a.join(b, "node", "full_outer").where(~F.col("a").eqNullSafe(F.col("b"))))
        if differ is not None:
            discard(differ)
        differ = found
    status = F.when(F.col("b").isNull(), "missing").when(F.col("a").isNull(), "extra").otherwise("changed")
    return differ.select(F.col("node").alias("offset"), status.alias("status"))


def fixity_audit(left: DataFrame, right: DataFrame, offset: str, columns: Sequence[str], fanout: int = 64) -> DataFrame:
    """audit of the trees of two replicas."""
    trees = [tree(x, offset, columns, fanout) for x in (left, right)]
    out = audit(*trees, fanout)
    discard(*trees[0], *trees[1])
    return out
