"""Row numbers and first rows in a stated order."""

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BLOCK = 65536


def blocked(df: DataFrame, pos: str, block: int = BLOCK) -> DataFrame:
    return df.withColumn("_block", F.floor(F.col(pos) / block))


def joined_null_safe(left: DataFrame, right: DataFrame, names: list[str], how: str = "left") -> DataFrame:
    """NULL keys are keys like any other."""
    renamed = right.withColumnsRenamed({n: f"_r_{n}" for n in names})
    on = F.lit(True)
    for n in names:
        on = on & left[n].eqNullSafe(renamed[f"_r_{n}"])
    return left.join(renamed, on, how).drop(*[f"_r_{n}" for n in names])


def carried(blocks: DataFrame, keys: list[str], values: list[str], fold, merge) -> DataFrame:
    """(keys, _block, in_<value>): what the earlier blocks of a key hand on to each block.

    blocks: (keys, _block, values), one row per block. `fold` is the aggregate over earlier ones, `merge` joins a part's own
    with what came before the part. Positions may be sparse, so a key may have very many blocks: they are summed up in
    parts of 2^16, and those again, and no window holds more than 2^16 rows.
    """
    levels = [blocks.select(*keys, "_block", F.shiftright("_block", 16).alias("_part"), *values)]
    above = levels[0].groupBy(*keys, F.col("_part").alias("_block")).agg(*[fold(F.struct("_block", v), v).alias(v) for v in values])
    levels.append(above.select(*keys, "_block", F.shiftright("_block", 16).alias("_part"), *values))
    top = levels[1].groupBy(*keys, F.col("_part").alias("_block")).agg(*[fold(F.struct("_block", v), v).alias(v) for v in values])
    levels.append(top.select(*keys, "_block", F.lit(0).cast("bigint").alias("_part"), *values))
    entered = None
    for level in reversed(levels):
        before = Window.partitionBy(*keys, "_part").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
        own = level.withColumns({f"in_{v}": fold(None, v).over(before) for v in values})
        if entered is not None:
            parents = entered.select(*keys, F.col("_block").alias("_part"), *[F.col(f"in_{v}").alias(f"_up_{v}") for v in values])
            own = joined_null_safe(own, parents, [*keys, "_part"])
            own = own.withColumns({f"in_{v}": merge(F.col(f"in_{v}"), F.col(f"_up_{v}")) for v in values})
        entered = own.select(*keys, "_block", *[f"in_{v}" for v in values])
    return entered


def summed(_, value: str) -> Column:
    return F.sum(value)


def plus(own: Column, before: Column) -> Column:
    return F.coalesce(own, F.lit(0)) + F.coalesce(before, F.lit(0))


def row_index(df: DataFrame, pos: str, output: str = "index", keys: tuple[str, ...] = (), start: int = 1, block: int = BLOCK) -> DataFrame:
    """Adds start, start+1, ... in the order of `pos` (a whole number, unique within `keys`).

    Rows are ranked inside blocks of positions and the numbers of rows in earlier blocks are added; positions may be sparse.
    A NULL key is a key like any other; a row without a position has no place and its number is NULL.
    """
    placed = blocked(df.where(F.col(pos).isNotNull()), pos, block)
    inside = Window.partitionBy(*keys, "_block").orderBy(pos)
    counts = placed.groupBy(*keys, "_block").agg(F.count(F.lit(1)).alias("_n"))
    offsets = carried(counts, list(keys), ["_n"], summed, plus)
    ranked = joined_null_safe(placed.withColumn("_rank", F.row_number().over(inside)), offsets, [*keys, "_block"])
    number = F.col("_rank") + F.coalesce(F.col("in__n"), F.lit(0)) + (start - 1)
    numbered = ranked.withColumn(output, number.cast("bigint")).select(*df.columns, output)
    return numbered.unionByName(df.where(F.col(pos).isNull()).withColumn(output, F.lit(None).cast("bigint")))


def file_row_index(df: DataFrame, output: str = "index", start: int = 1) -> DataFrame:
    """Adds row numbers in file order (files by path) to a table just read from files.

    Parquet rows carry their place in the file, so a row needs the number of rows in earlier files only: one small row per file. A
    row of another format takes its place from its split: a split keeps its rows together in one task, so the place is that in the
    task less that of the split's first row, and earlier splits, one small row each, give the offset. The rows themselves are not
    shuffled unless the listing of files or splits outgrows a broadcast.
    """
    file = {"_file": F.col("_metadata.file_path")}
    if has_row_places(df):
        placed = df.withColumns(file | {"_place": F.col("_metadata.row_index")})
        return _numbered(placed, ["_file"], F.col("_place"), output, start)
    placed = df.withColumns(file | {"_start": F.col("_metadata.file_block_start"), "_place": F.monotonically_increasing_id()})
    return _numbered(placed, ["_file", "_start"], F.col("_place") - F.col("_first"), output, start)


def has_row_places(df: DataFrame) -> bool:
    """Does the table's format say each row's place in its file?"""
    try:
        df.select("_metadata.row_index").schema
    except AnalysisException:
        return False
    return True


def _numbered(placed: DataFrame, part: list[str], inside: Column, output: str, start: int) -> DataFrame:
    parts = placed.groupBy(*part).agg(F.min("_place").alias("_first"), F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy(*part).rowsBetween(Window.unboundedPreceding, -1)
    offsets = parts.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n")
    numbered = placed.join(offsets, part).withColumn(output, inside + F.col("_before") + start)
    return numbered.drop("_place", "_first", "_before", *part)


def first_rows(df: DataFrame, n: int | None, *order: str | Column) -> DataFrame:
    """The first n rows in a stated order; all rows when n is None."""
    return df if n is None else df.orderBy(*order).limit(n)
