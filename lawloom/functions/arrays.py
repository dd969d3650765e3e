"""Array helpers used inside one row."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CUT = "\x85"


def bind(value: Column, use) -> Column:
    """`use(value)` with the value worked out once, however often `use` names it.

    Inside one expression Spark has no other name for a part: without this, every mention is
    another copy to evaluate, and nested mentions multiply.
    """
    return F.get(F.transform(F.array(value), use), F.lit(0))


def running_sum(values: Column, chunk: int = 128) -> Column:
    """Inclusive running sum of an int array.

    Arrays grow by copying, so the fold runs over chunks and then over chunk totals;
    the copying stays far below quadratic for long arrays.
    """
    empty = F.array().cast("array<int>")

    def grow(acc, x):
        return F.concat(acc, F.array(F.coalesce(F.try_element_at(acc, F.lit(-1)), F.lit(0)) + x))

    def local_sums(v):
        last_chunk = F.floor((F.greatest(F.size(v), F.lit(1)) - 1) / chunk).cast("int")
        return F.transform(
            F.sequence(F.lit(0), last_chunk), lambda k: F.aggregate(F.slice(v, k * chunk + 1, F.lit(chunk)), empty, grow)
        )

    def shifted(local):
        totals = F.transform(local, lambda part: F.coalesce(F.try_element_at(part, F.lit(-1)), F.lit(0)))
        offsets = F.concat(F.array(F.lit(0)), F.aggregate(totals, empty, grow))
        return F.flatten(
            F.zip_with(local, offsets, lambda part, offset: F.transform(F.coalesce(part, empty), lambda v: v + offset))
        )

    return bind(bind(values, local_sums), shifted)


def split_before(text: Column, *marks: str) -> Column:
    """Parts that begin at a mark, and what stands before the first one.

    The marks are single characters. `split` compiles a pattern on every call unless it is one
    plain character, so a separator is put in with `replace` and split at.
    """
    for m in marks:
        text = F.replace(text, F.lit(m), F.lit(CUT + m))
    return F.split(text, CUT)


def last_of(values: Column) -> Column:
    """Last entry or NULL."""
    return F.try_element_at(values, F.lit(-1))


def exploded(df: DataFrame, keep: list[str | Column], values: Column | str, pos: str, item: str) -> DataFrame:
    """(keep, pos, item): one row per array entry.

    The outer form with a filter after it, not a plain posexplode: for that one Catalyst adds
    `size(array) > 0` and pushes it down to the scan with the whole array expression copied in.
    """
    values = F.col(values) if isinstance(values, str) else values
    rows = df.select(*keep, F.posexplode_outer(values).alias(pos, item))
    return rows.where(F.col(pos).isNotNull())
