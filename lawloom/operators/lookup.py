"""Selecting ids, looking them up in the index, joining detail pages."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def first_per_key(df: DataFrame, key: str, order: list[str]) -> DataFrame:
    """The first row of every key. Copies of a hot key shrink on the map side before the shuffle."""
    rest = [c for c in df.columns if c != key]
    first = df.groupBy(key).agg(F.min_by(F.struct(*rest), F.struct(*order)).alias("_row"))
    return first.select(key, *[F.col(f"_row.`{c}`").alias(c) for c in rest]).select(*df.columns)


def selected_ids(index: DataFrame, ids: list | DataFrame | None = None, key: str = "bdSeq") -> DataFrame:
    """Ids as text, NULLs left out: all of the index, a given list, or a given table of ids."""
    if ids is None or (isinstance(ids, str) and ids.strip().upper() == "ALL"):
        ids = index.select(key)
    elif not isinstance(ids, DataFrame):
        ids = index.sparkSession.createDataFrame([(None if i is None else str(i),) for i in ids], f"{key} string")
    return ids.select(F.col(ids.columns[0]).cast("string").alias(key)).where(F.col(key).isNotNull()).distinct()


def ordered_ids(spark: SparkSession, ids: list, key: str = "bdSeq") -> DataFrame:
    """(key, pos): a given list of ids as text with the place of each one's first mention; NULLs left out."""
    rows = spark.createDataFrame([(None if i is None else str(i), n) for n, i in enumerate(ids)], f"{key} string, pos long")
    return rows.where(F.col(key).isNotNull()).groupBy(key).agg(F.min("pos").alias("pos"))


def in_order(found: DataFrame, ids: DataFrame, key: str = "bdSeq", pos: str = "pos", output: str = "selected_pos") -> DataFrame:
    """Adds the place that each row's id has in the selection; sort by it to walk the rows as they were asked for."""
    return found.join(ids.select(key, F.col(pos).alias(output)), key)


def lookup(index: DataFrame, ids: DataFrame, order: list[str], key: str = "bdSeq") -> DataFrame:
    """First index row of every selected id; ids that the index lacks give no row."""
    keyed = index.withColumn(key, F.col(key).cast("string")).join(ids.select(key), key, "left_semi")
    return first_per_key(keyed, key, order)


def unmatched(index: DataFrame, ids: DataFrame, key: str = "bdSeq") -> DataFrame:
    """Selected ids that the index does not hold."""
    return ids.join(index.select(F.col(key).cast("string").alias(key)).distinct(), key, "left_anti")


def with_detail_page(
    rows: DataFrame,
    pages: DataFrame,
    url: str = "detail_url",
    page_url: str = "url",
    html: str = "html",
    page_order: tuple[str, ...] = (),
) -> DataFrame:
    """Adds the page of every row's link; NULL where there is none.

    Of several copies of a page the first by `page_order`, then by a hash of its text, is taken. Only pages that a row links
    to are read further, and rows without a link take no part in the join.
    """
    order = list(page_order)
    wanted = rows.select(url).where(F.col(url).isNotNull()).distinct()
    copies = pages.select(F.col(page_url).alias(url), F.col(html).alias("html"), *order).join(wanted, url, "left_semi")
    fetched = first_per_key(copies.withColumn("_hash", F.xxhash64("html")), url, [*order, "_hash"]).select(url, "html")
    linked = rows.where(F.col(url).isNotNull()).join(fetched, url, "left")
    unlinked = rows.where(F.col(url).isNull()).withColumn("html", F.lit(None).cast("string"))
    return linked.unionByName(unlinked).select(url, *[c for c in rows.columns if c != url], "html")


def last_per_key(df: DataFrame, keys: list[str], pos: str, values: list[str]) -> DataFrame:
    """The last values, by `pos`, of every key: a later entry replaces an earlier one."""
    last = df.groupBy(*keys).agg(F.max_by(F.struct(*values), pos).alias("_row"))
    return last.select(*keys, *[F.col(f"_row.`{v}`").alias(v) for v in values])
