"""Carrying a value down ordered rows when one key may hold a large part of the table.

Rows of a key are cut into blocks of positions. Windows run inside (key, block), so a hot key
spreads over many tasks; one small row per block then carries the state from block to block.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lawloom.operators.order import BLOCK, blocked, carried, joined_null_safe, plus, summed


def _last(placed: Column | None, value: str) -> Column:
    """The last non-null value: of a group, by the struct that begins with its place, or of a window in its order."""
    return F.last(value, ignorenulls=True) if placed is None else F.max_by(value, F.when(F.col(value).isNotNull(), placed.getField("_block")))


def fill_forward(df: DataFrame, keys: list[str], pos: str, columns: dict[str, str], block: int = BLOCK) -> DataFrame:
    """Adds, for every output name, the last non-null value of its column up to the row.

    `pos` is a whole number, unique within its key, so a block holds at most `block` rows. A NULL key is a key like any
    other; rows without a position come after none and keep their own value.
    """
    placed = blocked(df.where(F.col(pos).isNotNull()), pos, block)
    inside = Window.partitionBy(*keys, "_block").orderBy(pos)
    local = placed.withColumns({o: F.last(c, ignorenulls=True).over(inside) for o, c in columns.items()})
    ends = placed.groupBy(*keys, "_block").agg(
        *[F.max_by(c, F.when(F.col(c).isNotNull(), F.col(pos))).alias(f"_end_{o}") for o, c in columns.items()]
    )
    entries = carried(ends, keys, [f"_end_{o}" for o in columns], _last, F.coalesce)
    joined = joined_null_safe(local, entries, [*keys, "_block"])
    filled = joined.withColumns({o: F.coalesce(F.col(o), F.col(f"in__end_{o}")) for o in columns})
    names = [*df.columns, *[o for o in columns if o not in df.columns]]
    rest = df.where(F.col(pos).isNull()).withColumns({o: F.col(c) for o, c in columns.items()})
    return filled.select(*names).unionByName(rest.select(*names))


def previous(df: DataFrame, keys: list[str], pos: str, column: str, output: str, block: int = BLOCK) -> DataFrame:
    """Adds the value of `column` in the row before, by `pos` within the key; NULL for a first row and for rows without a position.

    `column` has no NULLs. The first row of a block gets what the blocks before it hand on.
    """
    placed = blocked(df.where(F.col(pos).isNotNull()), pos, block)
    inside = Window.partitionBy(*keys, "_block").orderBy(pos)
    local = placed.withColumn(output, F.lag(column).over(inside))
    ends = placed.groupBy(*keys, "_block").agg(F.max_by(column, pos).alias("_end"))
    joined = joined_null_safe(local, carried(ends, keys, ["_end"], _last, F.coalesce), [*keys, "_block"])
    found = joined.withColumn(output, F.coalesce(F.col(output), F.col("in__end"))).select(*df.columns, output)
    return found.unionByName(df.where(F.col(pos).isNull()).withColumn(output, F.lit(None).cast(df.schema[column].dataType)))


def running_count(df: DataFrame, keys: list[str], pos: str, flag: str, output: str, block: int = BLOCK) -> DataFrame:
    """Adds the number of rows with `flag` true up to and including the row; NULL for a row without a position."""
    placed = blocked(df.where(F.col(pos).isNotNull()), pos, block)
    inside = Window.partitionBy(*keys, "_block").orderBy(pos).rowsBetween(Window.unboundedPreceding, 0)
    one = F.coalesce(F.col(flag).cast("bigint"), F.lit(0))
    local = placed.withColumn(output, F.sum(one).over(inside))
    totals = placed.groupBy(*keys, "_block").agg(F.sum(one).alias("_n"))
    joined = joined_null_safe(local, carried(totals, keys, ["_n"], summed, plus), [*keys, "_block"])
    counted = joined.withColumn(output, (F.col(output) + F.coalesce("in__n", F.lit(0))).cast("bigint")).select(*df.columns, output)
    return counted.unionByName(df.where(F.col(pos).isNull()).withColumn(output, F.lit(None).cast("bigint")))
