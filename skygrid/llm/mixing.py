"""Mixing sources to target weights by capped water-filling.

Every source is to give words in proportion to its weight, but never more
than ``max_epochs`` times the words that it has. Sources that would pass that
cap stop there and the rest is shared anew, until none is above. In closed
form that is target = min(cap, level * weight) with one common level, which
sorting the sources by cap / weight finds in one pass.

A source's target is met by whole repetitions of all its documents and one
fractional repetition: documents in the order of a seeded hash, until the
words are reached. The running sums that this needs are kept small: words are
first summed by (source, leading hash digits), and only the one cell in which a
source's share ends is put in order.

Native: DataFrame functions only.

Defined cases
- text null, empty or blank: size 0, taken 0
- source null: a source of its own, last in order
- all sizes 0, or an empty table: targets 0, or no rows
- repeated rows: each counts; equal ids share a hash, so a fractional
  repetition treats rows with one id and one size alike only in order
- extra columns, whatever their names, are dropped by ``mix`` and kept by ``mixed_rows``
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, written

#: Leading hex digits of the hash that name a cell: 4,096 cells a source.
CELL_DIGITS = 3


def word_count(text: Column) -> Column:
    """Words of a text: each run of non-blanks leaves one character."""
    marked = F.regexp_replace(text, WORD, "\x01")
    return F.coalesce(F.length(F.translate(marked, " \t\n\x0b\x0c\r", "")), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: Sequence[int], share: float, max_epochs: int) -> DataFrame:
    """source, source_size -> with target (double).

    One row a source comes in; the windows run over sources, not over rows.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    ranked = sizes.withColumn("weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), ((F.row_number().over(order) - 1) % len(weights) + 1).cast("int")))
    ranked = ranked.withColumn("cap", F.col("source_size").cast("double") * max_epochs)
    level = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    below, upto = level.rowsBetween(Window.unboundedPreceding, -1), level.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    every = Window.partitionBy()
    ranked = (
        ranked.withColumn("goal", F.sum("source_size").over(every) * F.lit(share))
        .withColumn("spent", F.coalesce(F.sum("cap").over(below), F.lit(0.0)))
        .withColumn("open", F.sum("weight").over(upto))
    )
    # In this order the first source that its cap doesn't stop sets the level for itself and all after it.
    free = F.col("cap") * F.col("open") > (F.col("goal") - F.col("spent")) * F.col("weight")
    first = ranked.withColumn("first", F.min(F.when(free, F.struct(F.col("cap") / F.col("weight"), F.col("source").isNull(), "source", "spent", "open"))).over(every))
    unstopped = F.col("first").isNotNull() & (F.struct(F.col("cap") / F.col("weight"), F.col("source").isNull(), "source", "spent", "open") >= F.col("first"))
    target = F.when(unstopped, (F.col("goal") - F.col("first.spent")) * F.col("weight") / F.col("first.open")).otherwise(F.col("cap"))
    return first.select("source", "source_size", target.alias("target"))


def mix(docs: DataFrame, weights: Sequence[int] = (3, 1, 2), share: float = 1.5, max_epochs: int = 2, seed: int = 0, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", marked: bool = False) -> DataFrame:
    """doc_id, size, source_size, target, taken (and mark, a hash of the text, if marked), one row for each row of docs.

    taken is in words: whole repetitions of the document, and its part of the
    source's fractional repetition, in which at most one document of a source is cut.
    """
    key = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))))
    # The one pass over the texts; what follows reads a few bytes a document.
    sized = written(docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), word_count(F.col(text_col)).alias("size"), key.alias("key"), *[F.xxhash64(F.col(text_col)).alias("mark")] * marked))
    cell = F.substring("key", 1, CELL_DIGITS)
    cells = sized.groupBy("source", cell.alias("cell")).agg(F.sum("size").alias("cell_size"))
    targets = source_targets(cells.groupBy("source").agg(F.sum("cell_size").alias("source_size")), weights, share, max_epochs)
    goal = F.floor("target").cast("long")
    whole = F.when(F.col("source_size") > 0, F.expr("floor(target) div source_size")).otherwise(F.lit(0)).cast("long")
    plan = targets.withColumn("whole", whole).withColumn("extra", goal - F.col("whole") * F.col("source_size"))
    running = Window.partitionBy("source").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    left = F.greatest(F.lit(0), F.least(F.col("cell_size"), F.col("extra") - F.col("before"))).cast("long")
    cells = (
        cells.withColumn("before", F.coalesce(F.sum("cell_size").over(running), F.lit(0)))
        .withColumnsRenamed({"source": "s"})
        .join(plan, F.col("s").eqNullSafe(F.col("source")))
        .select("s", "cell", "cell_size", "source_size", "target", "whole", left.alias("left"))
    )
    rows = sized.join(cells, F.col("s").eqNullSafe(F.col("source")) & (F.col("cell") == F.substring("key", 1, CELL_DIGITS)))
    split = (F.col("left") > 0) & (F.col("left") < F.col("cell_size"))
    before = F.sum("size").over(Window.partitionBy("source", "cell").orderBy("key", "doc_id", "size", *["mark"] * marked).rowsBetween(Window.unboundedPreceding, -1))
    part = F.greatest(F.lit(0), F.least(F.col("size"), F.col("left") - F.coalesce(before, F.lit(0))))
    whole_cells = rows.where(~split).withColumn("part", F.when(F.col("left") > 0, F.col("size")).otherwise(F.lit(0)))
    out = whole_cells.unionByName(rows.where(split).withColumn("part", part))
    return out.select("doc_id", *["mark"] * marked, "size", "source_size", "target", (F.col("whole") * F.col("size") + F.col("part")).cast("long").alias("taken"))


def mixed_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of docs as often as the mix takes them, whole, with the columns of docs.

    A document whose last repetition is cut gets it whole if half or more of it is taken.
    """
    mixed = mix(docs, id_col=id_col, text_col=text_col, marked=True, **options)
    copies = F.when(F.col("size") > 0, F.floor((F.col("taken") * 2 + F.col("size")) / (F.col("size") * 2))).otherwise(0).cast("int")
    # By id and text, so that rows under one id, or under none, part and keep their own number.
    taken = mixed.select(F.col("doc_id").alias("_mix_id"), F.col("mark").alias("_mix_mark"), copies.alias("_mix_copies")).where("_mix_copies > 0").groupBy("_mix_id", "_mix_mark").agg(F.max("_mix_copies").alias("_mix_copies"))
    rows = docs.join(taken, docs[id_col].eqNullSafe(taken["_mix_id"]) & (F.xxhash64(docs[text_col]) == taken["_mix_mark"]))
    return rows.withColumn("_mix_copy", F.explode(F.sequence(F.lit(1), F.col("_mix_copies")))).select(*[docs[c] for c in docs.columns])
