"""Sharding by extendible hashing.

The directory is indexed by the leading bits of a hash of the key. A bucket
that holds more bytes than the limit splits on its next bit, and no other
bucket changes; so a shard is the shortest hash prefix whose rows fit.

Sizes are summed once at a depth at which cells are small, and the sums of all
shorter prefixes come from these cells; only cells that are still too large go
on to the next depth. Nothing but the number of such cells comes to the driver.

Native: DataFrame functions only.

Defined cases
- key null: hashed as the empty text; text null: 0 bytes
- a key that repeats: its rows part by the hash of ``tie_cols`` (unless told otherwise all other columns), whose bits
  follow the key's bits; so one key with a third of all rows splits as well
- one row above the limit, or rows alike in key and ties that are above it
  together: a shard of their own, ``oversized``
- an empty table: no shards
- extra columns are kept out of the result, whatever their names
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import discard, free_name, written

#: Bits of the key's hash and of the tie's hash; hex digits times 4.
KEY_BITS, TIE_BITS = 32, 28
ALL_BITS = KEY_BITS + TIE_BITS


def hash_bits(key: Sequence[str], ties: Sequence[str]) -> Column:
    """60 bits: the key's leading 32, then 28 of key and ties."""

    def md5(cols: Sequence[str]) -> Column:
        return F.md5(F.concat_ws("\x1f", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in cols]))

    digits = F.concat(F.substring(md5(key), 1, KEY_BITS // 4), F.substring(md5([*key, *ties]), 9, TIE_BITS // 4))
    return F.conv(digits, 16, 10).cast("long")


def prefix(bits: Column, depth: Column | int) -> Column:
    """The leading depth bits as a number."""
    return F.call_function("shiftright", bits, F.lit(ALL_BITS).cast("int") - (F.lit(depth) if isinstance(depth, int) else depth))


def extendible_shards(df: DataFrame, key: Sequence[str], size: Column, limit: int, tie_cols: Sequence[str] | None = None, step_bits: int = 4) -> tuple[DataFrame, DataFrame]:
    """(rows, directory).

    rows: the key columns, n_bytes, shard (its bits as text, "" if all fits in one), depth, shard_bytes, shard_rows, oversized.
    directory: shard, depth, shard_bytes, shard_rows, oversized.
    """
    # The one pass over the input; from here on a row is its key, its size and 60 bits.
    if tie_cols is None:  # all else that a row has; maps have no hash
        others = [f.name for f in df.schema if f.name not in key and "map<" not in f.dataType.simpleString()]
        tie = free_name(df, "_tie")
        df, tie_cols = (df.withColumn(tie, F.xxhash64(*[F.col(f"`{c}`") for c in others])), [tie]) if others else (df, ())
    rows = written(df.select(*key, size.cast("long").alias("n_bytes"), hash_bits(key, tie_cols).alias("_bits")))
    weighed = rows.select("_bits", "n_bytes")
    total = weighed.agg(F.sum("n_bytes")).first()[0] or 0
    shards = max(1, -(-total // limit))
    depth, shallow = min(ALL_BITS, (shards - 1).bit_length() + step_bits), 0
    cells, todo = None, weighed
    spent: list[DataFrame] = []
    while True:
        # Sums of the cells at this depth, and from them those of every prefix since the last depth.
        fine = written(todo.groupBy(prefix(F.col("_bits"), depth).alias("_cell")).agg(F.sum("n_bytes").alias("b"), F.count("*").alias("n"), F.min("_bits").alias("lo"), F.max("_bits").alias("hi")))
        levels = F.explode(F.sequence(F.lit(shallow), F.lit(depth)))
        by_level = fine.withColumn("level", levels).withColumn("p", F.call_function("shiftright", F.col("_cell"), F.lit(depth) - F.col("level")))
        sums = by_level.groupBy("level", "p").agg(F.sum("b").alias("b"), F.sum("n").alias("n"), F.min("lo").alias("lo"), F.max("hi").alias("hi"))
        ends = sums.where((F.col("b") <= limit) | (F.col("lo") == F.col("hi")) | (F.col("level") == ALL_BITS))
        found = written(
            by_level.select("_cell", "level", "p").join(ends.select("level", "p", "b", "n").hint("merge"), ["level", "p"])  # a file's size says little of its prefixes
            .groupBy("_cell").agg(F.min(F.struct("level", "p", "b", "n")).alias("s"))
            .select("_cell", F.lit(depth).alias("_depth"), "s.*")
        )
        cells = found if cells is None else cells.unionByName(found)
        large = written(fine.join(found, "_cell", "left_anti").select("_cell"))
        discard(fine)
        if depth == ALL_BITS or not large.count():
            discard(large, *spent)
            break
        # Each step's rows are written: the next step's plan begins there, however many steps a hot key takes.
        todo = written(todo.withColumn("_cell", prefix(F.col("_bits"), depth)).join(large, "_cell", "left_semi").drop("_cell"))
        discard(large, *spent)
        spent = [todo]
        step_bits = min(16, 2 * step_bits)  # few cells are left, and a hot key's rows part only after its 32 bits
        shallow, depth = depth + 1, min(ALL_BITS, depth + step_bits)
    name = F.when(F.col("level") == 0, F.lit("")).otherwise(F.lpad(F.conv(F.col("p").cast("string"), 10, 2), F.col("level"), F.lit("0")))
    directory = cells.select(name.alias("shard"), F.col("level").alias("depth"), F.col("b").alias("shard_bytes"), F.col("n").alias("shard_rows"), (F.col("b") > limit).alias("oversized")).distinct()
    # A row's cell, at whichever depth its cell was settled.
    depths = [r[0] for r in cells.select("_depth").distinct().collect()]
    at = rows.withColumn("_at", F.array(*[F.struct(F.lit(d).alias("_depth"), prefix(F.col("_bits"), d).alias("_cell")) for d in sorted(depths)]))
    if len(depths) > 1:
        at = at.withColumn("_at", F.explode("_at"))
    else:
        at = at.withColumn("_at", F.element_at("_at", 1)) if depths else at.where("false").withColumn("_at", F.lit(None).cast("struct<_depth:int,_cell:bigint>"))
    at = at.select(*key, "n_bytes", "_at._depth", "_at._cell")
    assigned = at.join(cells, ["_depth", "_cell"])
    return assigned.select(*key, "n_bytes", name.alias("shard"), F.col("level").alias("depth"), F.col("b").alias("shard_bytes"), F.col("n").alias("shard_rows"), (F.col("b") > limit).alias("oversized")), directory
