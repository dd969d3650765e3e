"""Financial case pages: choosing tables, label maps, detail links and five fields."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lawloom import constants as C
from lawloom.functions.arrays import bind, last_of
from lawloom.functions.markup import (
    after_open, attribute, block, cells, cells_of, inside, line_text, open_tag, opens, pieces, prepare, raw_of, until,
)
from lawloom.functions.text import blank_to_null, clean_cell, keep_law_lines, null_word_to_blank, strip

ANY_TAG = r"<[A-Za-z][^>]*>"


def _score(text: Column, words: list[str]) -> Column:
    return bind(text, lambda t: sum((F.contains(t, F.lit(w)).cast("int") for w in words), F.lit(0)))


def _shown(fragment: Column) -> Column:
    return keep_law_lines(line_text(fragment))


def _rows(table: Column) -> Column:
    return pieces(inside(table, "table"), "tr")


def _body_rows(table: Column) -> Column:
    return pieces(until(inside(F.get(pieces(table, "tbody"), F.lit(0)), "tbody"), r"(?i)</table\s*>"), "tr")


def _first_row(table: Column) -> Column:
    """First of `_rows`, '' without one: what stands before the next row or the table's end is read, no more."""
    first = F.regexp_extract(after_open(table), rf"(?is)(</table\s*>|{opens('tr')}.*?(?={opens('tr')}|</table\s*>|\z))", 1)
    return bind(first, lambda r: F.when(F.startswith(r, F.lit("</")), F.lit("")).otherwise(r))


#: Tags that body rows are counted by. The one of a table body is read to its end, as `inside` does, when there is one before the next body.
BODY_TAG = r"(?i)<(?:tbody(?=[\s>/])(?:(?:(?!<tbody[\s>/])[^>])*+>)?+|tr(?=[\s>/])|/t(?:body|able)\s*>)"


def _has_body_rows(table: Column, n: int) -> Column:
    """size(_body_rows(table)) >= n, from one pass over the tags."""

    def counted(tags):
        kinds = F.transform(tags, lambda t: F.lower(F.substring(t, 1, 3)))
        from_body = F.transform(kinds, lambda k: F.when(k == "<tb", "b").when(k == "<tr", "r").otherwise("e"))
        return F.regexp_extract(F.array_join(from_body, ""), "b(r*)", 1)

    return F.length(counted(F.regexp_extract_all(table, F.lit(BODY_TAG), F.lit(0)))) >= n


def _first_best(tables: Column, score) -> Column:
    """Table of the highest score; the first one wins among equals."""
    return F.array_max(
        F.transform(tables, lambda t, i: F.struct(score(t).alias("score"), (-i).alias("order"), t.alias("table")))
    ).table


def list_table(page: Column, words: list[str] = C.LIST_TABLE_WORDS) -> Column:
    """The table whose header holds most of the words; five or more body rows add one."""

    def score(t):
        head = F.regexp_extract(t, r"(?is)<thead(?=[\s>])[^>]*>(.*?)</thead\s*>", 1)
        first_cells = F.transform(cells(_first_row(t)), lambda c: c.raw)
        shown = bind(cells_of(head, "th"), lambda ths: F.when(F.size(ths) > 0, ths).otherwise(first_cells))
        text = F.array_join(F.transform(shown, _shown), " ")
        return _score(text, words) + F.when(_has_body_rows(t, 5), 1).otherwise(0)

    return _first_best(pieces(page, "table"), score)


def section_table(page: Column, anchor: str | None = C.SECTION_ANCHOR, words: list[str] = C.SECTION_TABLE_WORDS) -> Column:
    """First table after the anchor text; else the longest-worded table of more than 30 characters."""
    after = F.regexp_extract(page, rf"(?s){anchor}(.*)\z", 1) if anchor else F.lit("")
    read = F.transform(pieces(page, "table"), lambda t: F.struct(t.alias("table"), line_text(inside(t, "table")).alias("text")))
    long_tables = F.filter(read, lambda t: F.length(strip(t.text)) > 30)
    best = _first_best(long_tables, lambda t: _score(t.text, words)).table
    return F.coalesce(F.get(pieces(after, "table"), F.lit(0)), best)


def label_rows(table: Column) -> Column:
    """array<struct<label,value>>: the first header cell, else a short first cell, and the last data cell."""

    def row(r):
        return bind(cells(r), lambda c: bind(raw_of(c, "th"), lambda ths: bind(raw_of(c, "td"), lambda tds: of_cells(ths, tds))))

    def of_cells(ths, tds):
        short = bind(_shown(F.get(tds, F.lit(0))), lambda first: F.when(F.length(first) <= 12, first))
        label = F.when(F.size(ths) > 0, _shown(F.get(ths, F.lit(0)))).otherwise(short)
        return F.struct(
            F.replace(F.coalesce(label, F.lit("")), F.lit(" "), F.lit("")).alias("label"),
            F.coalesce(_shown(last_of(tds)), F.lit("")).alias("value"),
        )

    return F.filter(F.transform(_rows(table), row), lambda p: p.label != "")


def _row_value(table: Column, number: int) -> Column:
    """First data cell of the n-th body row."""
    row = F.get(_body_rows(table), F.lit(number - 1))
    return F.coalesce(_shown(F.get(cells_of(F.coalesce(row, F.lit("")), "td"), F.lit(0))), F.lit(""))


def service_name(page: Column) -> Column:
    """Name outside the table: text after a service heading, a heading itself, or what follows the label."""

    def guarded(c):
        t = _shown(c)
        return F.when((t != "") & (F.length(t) <= 120) & F.contains(t, F.lit("서비스")), t)

    headings = pieces(page, "h2|h3|h4")
    after_h3 = F.regexp_extract(page, rf"(?is){opens('h3')}[^>]*>(?:(?!</h3).)*?서비스.*?</h3\s*>(.*)\z", 1)
    first_block = block(F.get(pieces(after_h3, "p|div"), F.lit(0)))
    next_element = F.regexp_extract(page, r"(?is)서비스명[^<]*(?:</[^>]+>\s*)*<[A-Za-z][^>]*>([^<]*)", 1)
    return F.coalesce(guarded(first_block), guarded(block(F.get(headings, F.lit(0)))), _shown(next_element))


def with_financial_fields(df: DataFrame, html: str = "html", anchor: str | None = C.SECTION_ANCHOR) -> DataFrame:
    """Adds the five financial fields; null words of the relief field become ''."""
    df = df.withColumn("_page", prepare(F.col(html)))
    df = df.withColumn("_table", section_table(F.col("_page"), anchor))
    df = df.withColumn("_labels", label_rows(F.col("_table")))
    values = {}
    for field in C.FIN_FIELDS:
        labels = [k for k, v in C.FIN_LABELS.items() if v == field]
        labelled = last_of(
            F.transform(F.filter("_labels", lambda p: p.label.isin(labels)), lambda p: p.value)
        )
        value = F.coalesce(blank_to_null(labelled), _row_value(F.col("_table"), C.FIN_ROW_NUMBERS[field]), F.lit(""))
        if field == "서비스명":
            value = F.coalesce(blank_to_null(value), service_name(F.col("_page")), F.lit(""))
        if field == "규제 특례 내용":
            value = null_word_to_blank(value)
        values[field] = value
    return df.withColumns(values).drop("_page", "_table", "_labels")


def clean_frame(df: DataFrame) -> DataFrame:
    """Cell cleaning over every text column."""
    texts = [f.name for f in df.schema.fields if f.dataType.simpleString() == "string"]
    return df.withColumns({c: clean_cell(F.col(f"`{c}`")) for c in texts})


def absolute_url(href: Column, page_url: str) -> Column:
    """A link as a browser gives it: relative ones against the page's address."""
    scheme, rest = page_url.split("://", 1)
    origin = f"{scheme}://{rest.split('/', 1)[0]}"
    path = page_url.split("?", 1)[0].split("#", 1)[0]
    folder = path.rsplit("/", 1)[0] + "/" if path.count("/") > 2 else origin + "/"
    return (
        F.when(href.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:"), href)
        .when(F.startswith(href, F.lit("//")), F.concat(F.lit(scheme + ":"), href))
        .when(F.startswith(href, F.lit("/")), F.concat(F.lit(origin), href))
        .when(F.startswith(href, F.lit("?")), F.concat(F.lit(path), href))
        .otherwise(F.concat(F.lit(folder), F.regexp_replace(href, r"^\./", "")))
    )


def _url_of(tag: Column, token: str, base: str, page_url: str | None) -> Column:
    """Address by `href`, else by `onclick`; a tag without an equals sign has neither."""

    def of_href(href):
        return F.when(F.contains(href, F.lit(token)), absolute_url(href, page_url) if page_url else href)

    def of_onclick(onclick):
        by_id = bind(F.regexp_extract(onclick, r"id=([0-9]{1,10})", 1), lambda i: F.when(i != "", F.concat(F.lit(base), i)))
        by_call = bind(F.regexp_extract(onclick, r"['\"]?([0-9]{1,10})['\"]?\)", 1), lambda i: F.when(i != "", F.concat(F.lit(base), i)))
        return F.coalesce(by_id, by_call)

    href = bind(strip(attribute(tag, "href")), of_href)
    onclick = bind(strip(F.regexp_extract(tag, r"(?is)\sonclick\s*=\s*(?:\"([^\"]*)|'[^']*)", 0)), of_onclick)
    return F.when(F.contains(tag, F.lit("=")), F.coalesce(href, onclick))


def row_link(row: Column, token: str = C.DETAIL_HREF_TOKEN, base: str = C.FIN_DETAIL_BASE, page_url: str | None = None) -> Column:
    """Detail link of a list row: the row tag, its fifth cell and what is in it, then links and buttons.

    With `page_url` relative links are resolved against it.
    """
    fifth = F.get(F.filter(pieces(row, "td|th"), lambda c: c.rlike("(?i)^<td")), F.lit(4))
    places = [
        F.array(open_tag(row)),
        F.regexp_extract_all(fifth, F.lit(ANY_TAG), F.lit(0)),
        F.regexp_extract_all(row, F.lit(rf"(?i){opens('a|button|em')}[^>]*>"), F.lit(0)),
    ]

    def first_url(tags):
        return F.get(F.filter(F.transform(tags, lambda t: _url_of(t, token, base, page_url)), lambda u: u.isNotNull()), F.lit(0))

    return F.coalesce(*[first_url(tags) for tags in places])


def page_links(
    page: Column, token: str = C.DETAIL_HREF_TOKEN, base: str = C.FIN_DETAIL_BASE, literal: str = C.FIN_DETAIL_LITERAL,
    page_url: str | None = None,
) -> Column:
    """All detail links of a list page, in first-seen order without repeats; relative ones against `page_url`, else `base`."""
    return bind(page, lambda p: _links_of(p, token, base, literal, page_url))


def _links_of(page: Column, token: str, base: str, literal: str, page_url: str | None) -> Column:
    table = list_table(page)
    rows = F.transform(_body_rows(table), lambda r: row_link(r, token, base, page_url or base))
    row_links = F.coalesce(F.filter(rows, lambda u: u.isNotNull()), F.array().cast("array<string>"))
    literals = F.regexp_extract_all(page, F.lit(literal), F.lit(0))
    calls = F.transform(
        F.regexp_extract_all(page, F.lit(r"goView\(['\"]?([0-9]{1,10})['\"]?\)"), F.lit(1)),
        lambda i: F.concat(F.lit(base), i),
    )
    return F.array_distinct(F.concat(row_links, literals, calls))
