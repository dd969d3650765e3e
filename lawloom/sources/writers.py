"""Writing tables: CSV with a byte-order mark, quoted CSV, JSON lines, one folder per law."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BOM = "\ufeff"


def in_file_order(df: DataFrame, *order: str) -> DataFrame:
    """Rows dealt into ranges of `order` and sorted inside them: written files, in the order of their names, then hold the rows in that order.

    Ranges are cut by a sample of the keys, so a frequent first key is spread over many of them.
    """
    return df.repartitionByRange(*order).sortWithinPartitions(*order)


def _with_bom(df: DataFrame) -> DataFrame:
    return df.withColumnRenamed(df.columns[0], BOM + df.columns[0])


def write_csv(df: DataFrame, path: str, bom: bool = True, mode: str = "errorifexists") -> None:
    """Header, '' and NULL both as an empty cell; every part file starts with the byte-order mark."""
    out = _with_bom(df) if bom else df
    out.write.mode(mode).option("header", True).option("escape", '"').option("emptyValue", "").csv(path)


def write_quoted_csv(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    df.write.mode(mode).option("header", True).option("quoteAll", True).option("escape", '"').csv(path)


def write_json_lines(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    df.write.mode(mode).option("ignoreNullFields", "false").json(path)


def write_per_law(
    df: DataFrame, path: str, law: str = "law_name", order: tuple[str, ...] = (), rows_per_file: int = 1_000_000,
    columns: list[str] | None = None, mode: str = "errorifexists"
) -> None:
    """One folder per law, with files of at most `rows_per_file` rows.

    Rows are dealt into ranges of law and `order`: small laws share a range and give one file each, a law of many rows is written by many
    tasks in its order, and there are no more files than laws and ranges together, but for those that rows_per_file adds.
    """
    dealt = in_file_order(df.withColumn("_law", F.col(law)), "_law", *order).select(*(columns or df.columns), "_law")
    writer = dealt.write.mode(mode).partitionBy("_law").option("header", True).option("escape", '"').option("emptyValue", "")
    writer.option("maxRecordsPerFile", rows_per_file).csv(path)


def write_if_any(df: DataFrame, path: str, writer=write_csv, wanted: bool = True) -> bool:
    """Writes only when wanted and when there are rows."""
    if not wanted or df.isEmpty():
        return False
    writer(df, path)
    return True


def write_raw_and_clean(raw: DataFrame, clean: DataFrame, folder: str, name: str, run_id: str) -> tuple[str, str]:
    """Twin outputs whose paths carry the run id."""
    paths = f"{folder}/{name}_raw_{run_id}", f"{folder}/{name}_clean_{run_id}"
    write_quoted_csv(raw, paths[0])
    write_quoted_csv(clean, paths[1])
    return paths
