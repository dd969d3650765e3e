"""List pages: index rows, filters on them, where paging stops."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lawloom import constants as C
from lawloom.functions.arrays import exploded
from lawloom.functions.markup import attribute, cells_of, class_token, flow_text, inside, pieces, plain_text, prepare, until
from lawloom.functions.text import blank_to_null, iso_date, joined_cells, list_detail_url
from lawloom.operators.carry import previous
from lawloom.sources.staging import stored

LIST_TABLE = r"(?i)^<table" + "".join(rf"(?={class_token(t)})" for t in C.LIST_TABLE_CLASSES)


def _list_rows(html: Column) -> Column:
    """array<array<string>>: cells of the rows of at least six cells of the first case table."""
    table = F.get(F.filter(pieces(prepare(html), "table"), lambda t: t.rlike(LIST_TABLE)), F.lit(0))
    body = until(inside(F.get(pieces(table, "tbody"), F.lit(0)), "tbody"), r"(?i)</table\s*>")
    rows = F.filter(F.transform(pieces(body, "tr"), lambda r: cells_of(r, "td")), lambda tds: F.size(tds) >= 6)
    return F.coalesce(rows, F.array().cast("array<array<string>>"))


def list_items(rows: Column) -> Column:
    """array<struct>: index fields of list rows."""
    anchor = r"(?is)<a(?=[\s>])[^>]*>(.*?)</a\s*>"

    def item(tds):
        fourth = F.get(tds, F.lit(3))
        linked = fourth.rlike(anchor)
        item_id = F.when(linked, blank_to_null(attribute(F.regexp_extract(fourth, r"(?is)(<a(?=[\s>])[^>]*>)", 1), "data-bdseq")))
        return F.struct(
            item_id.alias("bdSeq"),
            plain_text(F.get(tds, F.lit(0))).alias("번호"),
            plain_text(F.get(tds, F.lit(1))).alias("구분"),
            plain_text(F.get(tds, F.lit(2))).alias("기업명"),
            plain_text(F.when(linked, F.regexp_extract(fourth, anchor, 1)).otherwise(fourth)).alias("서비스명"),
            iso_date(plain_text(F.get(tds, F.lit(5)))).alias("designated_date"),
            list_detail_url(item_id).alias("detail_url"),
            joined_cells(F.transform(tds, flow_text)).alias("list_td_text"),
        )

    return F.transform(rows, item)


def pages_before_stop(
    pages: DataFrame, group: str, page: str, n_items: str, max_pages: int | None = None, groups: tuple[str, ...] | None = None,
    signature: str | None = None,
) -> DataFrame:
    """Pages of every group up to its first empty one, and no further than `max_pages`.

    With a `signature` column, a page that shows what the page before it shows was not turned: it ends the paging like an empty one.

    With a given list of groups there is at most one stop per listed group, so the stops are
    broadcast and a group of many pages is not sent to one task. Otherwise the join is left to
    Spark, which sees the size of the stops at run time.
    """
    bounded = pages.where(F.col(page) <= max_pages) if max_pages else pages
    if groups is not None:
        bounded = bounded.where(F.col(group).isin(list(groups)))
    # An aggregate of a condition, not a filter: Spark would work the count out again below any exchange.
    ended, seen = F.col(n_items) == 0, bounded
    if signature:
        seen = previous(bounded.select(group, page, n_items, signature), [group], page, signature, "_before")
        ended = ended | F.coalesce(F.col(signature) == F.col("_before"), F.lit(False))
    stops = seen.groupBy(group).agg(F.min(F.when(ended, F.col(page))).alias("_stop"))
    return (
        bounded.join(stops if groups is None else F.broadcast(stops), group, "left")
        .where(F.col("_stop").isNull() | (F.col(page) < F.col("_stop")))
        .drop("_stop")
    )


def matches_keyword(company: Column, service: Column, keyword: str) -> Column:
    text = F.concat(F.coalesce(company, F.lit("")), F.lit(" "), F.coalesce(service, F.lit("")))
    return F.contains(F.lower(text), F.lit(keyword.lower()))


def in_date_range(date: Column, since: str | None = None, until: str | None = None) -> Column:
    """Both ends included; a date that does not parse is kept."""
    parsed = F.when(date.rlike(r"^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}\z"), F.try_to_date(date, "yyyy-M-d"))
    ok = F.lit(True)
    if since:
        ok = ok & (parsed >= F.lit(since).cast("date"))
    if until:
        ok = ok & (parsed <= F.lit(until).cast("date"))
    return parsed.isNull() | ok


def index_rows(
    pages: DataFrame,
    forms: tuple[str, ...] = C.FORMS,
    max_pages: int | None = None,
    keyword: str | None = None,
    since: str | None = None,
    until: str | None = None,
) -> DataFrame:
    """Index of list pages (form_code, page_no, html), with page_no and pos for its order.

    The stop needs all pages read before any row is known to stay, so pages are cut once and their rows kept in files.
    """
    bounded = pages.where(F.col("page_no") <= max_pages) if max_pages else pages
    bounded = bounded.where(F.col("form_code").isin(list(forms)))
    read, _ = stored(bounded.select("form_code", "page_no", _list_rows(F.col("html")).alias("_rows")).withColumn("_n", F.size("_rows")), "list-rows")
    rows = exploded(
        pages_before_stop(read, "form_code", "page_no", "_n", max_pages, forms),
        ["form_code", "page_no"],
        list_items(F.col("_rows")),
        "pos",
        "_item",
    ).select("form_code", "page_no", "pos", "_item.*")
    if keyword:
        rows = rows.where(matches_keyword(F.col("기업명"), F.col("서비스명"), keyword))
    if since or until:
        rows = rows.where(in_date_range(F.col("designated_date"), since, until))
    return rows.select(*C.INDEX_COLUMNS, "page_no", "pos")


def ids_per_form(index: DataFrame) -> DataFrame:
    return index.groupBy("form_code").agg(F.count("bdSeq").alias("n_ids"))
