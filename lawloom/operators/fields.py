"""Six case fields of a detail page, each with the rule that filled it."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lawloom import constants as C
from lawloom.functions.arrays import CUT, bind, last_of, running_sum
from lawloom.functions.elements import children, elements, holds, markup_of, tag_parts
from lawloom.functions.markup import (
    FIELD, MARK_A, MARK_B, after_open, block, cells, flow_text, inside, node_lines, opens, pieces, prepare, raw_of,
    runs_after, steps, until,
)
from lawloom.functions.text import any_of, blank_to_null, collapse, compare_key, is_noise, kept_letters, letters_spaced, remove_once, strip_separators


CELL_PATHS = [
    ["form", "div", "table", "tbody", "tr", "td"], ["section", "form", "div", "table", "tbody", "tr", "td"], ["table", "tbody", "tr", "td"],
]
CONTENT_ELEMENTS = ["body", "section", "form", "div", "table", "thead", "tbody", "tfoot", "tr", "td", "th"]


def _tags(opening: str) -> str:
    return rf"{opening} \d++;"


# Complete rows: cells and rows that are all closed in order.
_ROWS = f"(?:{_tags('tr')}(?:{_tags('td')}{_tags('/td')}|{_tags('th')}{_tags('/th')})*+{_tags('/tr')})*+"
# Complete tables in a cell that has a row, a group and a table around it. They open and close nothing else, and no cell in them can complete
# one of CELL_PATHS: its last four names are those of the cell around them, which has completed it or lies in one that has.
TABLES_IN_CELL = (
    rf"((?<!/){_tags('table')}{_tags('tbody')}{_ROWS}{_tags('tr')}(?:{_tags('t[dh]')}{_tags('/t[dh]')})*+{_tags('td')})"
    rf"(?:{_tags('table')}(?:{_tags('tbody')}{_ROWS}{_tags('/tbody')}|{_ROWS}){_tags('/table')})++"
)


def _longest(parts: Column, found: Column) -> Column:
    """Markup of the element with the longest text, the first one among equals; NULL when none has text."""

    def sized(e):
        return bind(markup_of(parts, e), lambda raw: F.struct(F.length(flow_text(raw)).alias("size"), (-e["begin"]).alias("order"), raw.alias("raw")))

    return bind(F.array_max(F.transform(found, sized)), lambda best: F.when(best["size"] > 0, best["raw"]))


def content_cell(page: Column) -> Column:
    """Longest cell by the first of four selectors that has one; NULL when no cell has text.

    Selectors, specific to general: a form in the body's third section, a form in any section, any form, any table; from the form on
    always div, table, tbody, row, cell as ancestors of each other. A cell inside a cell found is part of it.
    """

    def of_page(parts, found):
        third = F.get(F.flatten(F.transform(
            F.filter(found, lambda e: e["tag"] == "body"), lambda body: F.slice(children(found, body, "section"), F.lit(3), F.lit(1)))), F.lit(0))

        def hits(k):
            return F.filter(found, lambda e: F.get(e["hit"], F.lit(k)))

        in_third = bind(third, lambda section: F.filter(hits(0), lambda e: F.coalesce(holds(section, e), F.lit(False))))
        return F.coalesce(_longest(parts, in_third), _longest(parts, hits(1)), _longest(parts, hits(0)), _longest(parts, hits(2)))

    return bind(tag_parts(page, CONTENT_ELEMENTS), lambda parts: bind(
        elements(parts, CONTENT_ELEMENTS, CELL_PATHS, ["body", "section"], TABLES_IN_CELL), lambda found: of_page(parts, found)))


def strong_sections(root: Column, title: Column) -> Column:
    """array<struct<header,body>>: a strong-headed paragraph and its sibling paragraphs up to the next one.

    Paragraphs deeper in tables or blocks are no siblings, and a section ends with the block that it stands in. Noise lines and repeats of the service title are left out; sections without text too.
    """
    strong = r"(?is)<strong\b[^>]*>(.*?)</strong\s*>"

    def body(own, title_key):
        # A repeat of the title begins with the same word; few paragraphs go on to the whole comparison.
        same_word = F.startswith(title_key, F.lower(F.regexp_extract(own, f"[{C.LETTERS}]++", 0)))
        is_title = (F.length(own) >= F.length(title_key)) & same_word & bind(
            kept_letters(own), lambda k: (F.length(k) == F.length(title_key)) & (F.lower(k) == title_key))
        keep = ~is_noise(own) & ~is_title
        return F.when(keep, F.concat(F.lit(" "), own)).otherwise("")

    def headed(inner, title_key):
        def with_header(header):
            own = bind(strip_separators(remove_once(flow_text(inner), header)), lambda o: body(o, title_key))
            return F.concat(F.lit(MARK_A), header, F.lit(FIELD), own)

        return bind(flow_text(F.regexp_extract(inner, strong, 1)), with_header)

    def tagged(p, title_key):
        return bind(
            block(p),
            lambda inner: F.when(F.contains(inner, F.lit("<")) & inner.rlike(strong), headed(inner, title_key)).otherwise(
                bind(flow_text(inner), lambda own: body(own, title_key))
            ),
        )

    def placed(parts, title_key):
        """Each paragraph with the depth of tables and blocks in which it stands, and a mark where one of those begins or ends."""
        nested = F.zip_with(parts, running_sum(steps(parts, "table|div")), lambda p, d: F.struct(p.alias("p"), d.cast("string").alias("d")))
        return F.array_join(F.transform(nested, lambda x, k: F.concat(
            F.when(k == 0, "").otherwise(F.concat(F.lit(MARK_B), x["d"], F.lit(FIELD + FIELD))),
            F.array_join(F.transform(pieces(x["p"], "p"), lambda p: marked(p, x["d"], title_key)), ""))), "")

    def marked(p, depth, title_key):
        return bind(tagged(p, title_key), lambda t: F.when(
            F.startswith(t, F.lit(MARK_A)), F.concat(F.lit(MARK_A), depth, F.lit(FIELD), F.substring(t, 2, 2**31 - 1))
        ).otherwise(F.concat(F.lit(MARK_B), depth, F.lit(FIELD), t)))

    def section(run):
        def read(parts):
            after = F.transform(F.slice(parts, F.lit(2), F.size(parts)), lambda p: F.struct(
                F.get(F.split(p, FIELD), F.lit(0)).cast("int").alias("depth"), F.get(F.split(p, FIELD), F.lit(1)).alias("text")))
            return F.struct(F.split(F.get(parts, F.lit(0)), FIELD).alias("head"), after.alias("after"))

        return bind(F.split(run, MARK_B), lambda parts: bind(read(parts), lambda s: of_head(s["head"], s["after"])))

    def of_head(head, after):
        own = F.get(head, F.lit(0)).cast("int")
        ended = F.array_position(F.transform(after, lambda p: p["depth"] < own), F.lit(True)).cast("int")
        siblings = F.slice(after, F.lit(1), F.when(ended > 0, ended - 1).otherwise(F.size(after)))
        siblings = F.filter(siblings, lambda p: p["depth"] == own)
        texts = F.concat(F.array(F.get(head, F.lit(2))), F.transform(siblings, lambda p: p["text"]))
        return F.struct(F.get(head, F.lit(1)).alias("header"), collapse(F.array_join(texts, "")).alias("body"))

    # The text up to the first table or block is a part too.
    parts = F.split(F.regexp_replace(root, r"(?i)</?(?:table|div)(?=[\s>/])", f"{CUT}$0"), CUT)
    joined = bind(compare_key(title), lambda key: bind(parts, lambda ps: placed(ps, key)))
    return F.filter(F.transform(runs_after(joined, MARK_A), section), lambda s: s.body != "")


def header_field(header: Column) -> Column:
    """Field of a section header: exact words first, then words it contains; else NULL."""
    words = F.create_map(*[F.lit(x) for pair in C.HEADER_FIELDS.items() for x in pair])

    def field(k):
        def has(word):
            return F.contains(k, F.lit(word))

        return F.coalesce(
            F.try_element_at(words, k),
            F.when(has("서비스") & (has("내용") | has("개요")), "서비스 내용")
            .when(has("특례"), "특례 내용")
            .when(has("부가") & has("조건"), "부가조건")
            .when(has("규제"), "규제")
            .when((has("기대") & has("효과")) | has("파급효과"), "기대효과")
            .when(has("개선") & (has("결과") | has("효과") | has("사항")), "개선결과"),
        )

    return bind(compare_key(header), field)


def label_pairs(root: Column) -> Column:
    """array<struct<label,value>> of table rows, then of definition lists, in page order.

    One header cell takes all data cells of its row; k header cells pair with k data cells;
    dt and dd pair when their counts agree. Noise and blanks are left out.
    """

    def pair(label, value):
        return F.struct(flow_text(label).alias("label"), value.alias("value"))

    empty = F.array().cast("array<struct<label:string,value:string>>")

    def row_pairs(row):
        return bind(cells(row), lambda c: bind(raw_of(c, "th"), lambda ths: bind(raw_of(c, "td"), lambda tds: paired(ths, tds))))

    def paired(ths, tds):
        joined = collapse(F.array_join(F.transform(tds, flow_text), " "))
        return (
            F.when((F.size(ths) == 1) & (F.size(tds) >= 1), F.array(pair(F.get(ths, F.lit(0)), joined)))
            .when((F.size(ths) >= 1) & (F.size(ths) == F.size(tds)), F.zip_with(ths, tds, lambda h, d: pair(h, flow_text(d))))
            .otherwise(empty)
        )

    def list_pairs(dl):
        def content(p):
            return until(after_open(p), r"(?i)</?d[dtl]\b")

        def zipped(dts, dds):
            both = F.zip_with(dts, dds, lambda t, d: pair(content(t), flow_text(content(d))))
            return F.when(F.size(dts) == F.size(dds), both).otherwise(empty)

        return bind(
            inside(dl, "dl"), lambda i: bind(pieces(i, "dt"), lambda dts: bind(pieces(i, "dd"), lambda dds: zipped(dts, dds)))
        )

    tables = F.flatten(F.transform(F.filter(pieces(root, "tr"), lambda row: row.rlike(rf"(?i){opens('th')}")), row_pairs))
    lists = F.flatten(F.transform(pieces(root, "dl"), list_pairs))
    return F.filter(F.concat(tables, lists), lambda p: (p.label != "") & (p.value != "") & ~is_noise(p.value))


def label_matches(label: Column, field: str, exact: bool = False) -> Column:
    """Does a label name the field? By contained alias, or by whole alias when `exact`."""
    aliases = C.FIELD_ALIASES[field]
    if exact:
        return F.replace(label, F.lit(" "), F.lit("")).isin([a.replace(" ", "") for a in aliases])
    return label.rlike("|".join(aliases))


def label_parts(lines: Column) -> Column:
    """Parts of a text, cut where some alias and a colon stand, in one pass: alias, colon with blanks, and what follows, FIELD between.

    Of the aliases that end at one colon the pass takes the longest; the others are its endings.
    """
    aliases = sorted({a for names in C.FIELD_ALIASES.values() for a in names}, key=lambda a: (-len(a), a))
    pattern = rf"({any_of(aliases)})({C.WS}*[:：]{C.WS}*)(?=.)"
    return runs_after(F.regexp_replace(lines, pattern, f"{MARK_A}$1{FIELD}$2{FIELD}"), MARK_A)


def labelled_text(parts: Column, field: str) -> Column:
    """Text after `alias :` for the first alias that has some and is not noise; else NULL.

    parts: what `label_parts` gives. An alias counts where it stands first; its text goes on to the end of the line, further labels
    on that line included.
    """
    every = {a for names in C.FIELD_ALIASES.values() for a in names}
    labels = F.transform(parts, lambda p: F.substring_index(p, FIELD, 1))

    def line_at(at):
        rest = F.get(F.split(F.array_join(F.slice(parts, at, F.size(parts)), ""), FIELD, 3), F.lit(2))
        return collapse(F.replace(F.regexp_extract(rest, "^(.*)", 1), F.lit(FIELD), F.lit("")))

    def of_alias(alias, labels):
        ending = sorted(a for a in every if a.endswith(alias))
        place = F.array_position(F.transform(labels, lambda l: l.isin(*ending)), F.lit(True)).cast("int")
        value = bind(place, lambda at: F.when(at > 0, line_at(at)))
        return bind(value, lambda v: F.when(~is_noise(v), v))

    return bind(labels, lambda l: F.coalesce(*[of_alias(a, l) for a in C.FIELD_ALIASES[field]]))


def _found(rule: str):
    """Function of a value: (value, src) where there is one."""

    def found(value: Column) -> Column:
        return F.when(value.isNotNull(), F.struct(value.alias("value"), F.lit(rule).alias("src")))

    return found


def with_fields(df: DataFrame, html: str = "html", title: str = "서비스명", exact_labels: bool = False) -> DataFrame:
    """Adds the six fields and their `src_` columns: strong, pairs, label, fallback or empty.

    A page that is absent (NULL) gives blank fields.
    """
    df = df.withColumn("_page", prepare(F.col(html)))
    df = df.withColumn("_root", F.coalesce(content_cell(F.col("_page")), F.col("_page")))
    df = df.withColumns(
        {
            "_strong": F.transform(
                strong_sections(F.col("_root"), F.col(title)),
                lambda s: F.struct(header_field(s.header).alias("field"), s.body.alias("body")),
            ),
            "_pairs": label_pairs(F.col("_root")),
        }
    )
    first_rules = {}
    for f in C.FIELDS:
        strong = F.array_join(F.transform(F.filter("_strong", lambda s: s.field == f), lambda s: s.body), " ")
        pairs = last_of(F.transform(F.filter("_pairs", lambda p: label_matches(p.label, f, exact_labels)), lambda p: p.value))
        first_rules["_f_" + f] = F.coalesce(*[bind(v, _found(name)) for name, v in [("strong", blank_to_null(strong)), ("pairs", blank_to_null(pairs))]])
    df = df.withColumns(first_rules)
    # Lines and the whole text are worked out only for pages where a field still needs them.
    missing = F.greatest(*[F.col(f"`{name}`").isNull() for name in first_rules])
    df = df.withColumn("_labelled", F.when(missing, label_parts(node_lines(F.col("_root")))))
    found = {}
    for name, f in zip(first_rules, C.FIELDS):
        rules = [("label", labelled_text(F.col("_labelled"), f))]
        if f == "서비스 내용":
            rules.append(("fallback", bind(flow_text(F.col("_root")), lambda whole: F.when(~is_noise(whole), whole))))
        rules.append(("empty", F.lit("")))
        found[name] = F.coalesce(F.col(f"`{name}`"), *[bind(v, _found(rule)) for rule, v in rules])
    df = df.withColumns(found).drop("_page", "_root", "_strong", "_pairs", "_labelled")
    return df.withColumns(
        {f: F.col(f"_f_{f}.value") for f in C.FIELDS} | {f"src_{f}": F.col(f"_f_{f}.src") for f in C.FIELDS}
    ).drop(*found)


def with_filled_list(df: DataFrame) -> DataFrame:
    """Adds extracted_columns: names of the fields that hold text, joined by '|'."""
    names = [F.when(F.col(f) != "", F.lit(f)) for f in C.FIELDS]
    return df.withColumn("extracted_columns", F.concat_ws("|", *names))


def case_tables(details: DataFrame, clean: bool = True, keys: tuple[str, ...] = ()) -> tuple[DataFrame, DataFrame]:
    """(main, meta) from index rows with fields: ten case columns, and twelve provenance columns."""

    def kept(name):
        column = F.coalesce(F.col(name), F.lit(""))
        return letters_spaced(column) if clean else column

    shown = details.withColumns({c: kept(c) for c in C.CASE_COLUMNS + ["list_td_text"]})
    main = shown.select(*keys, *C.CASE_COLUMNS)
    meta = with_filled_list(shown).select(*keys, *C.META_COLUMNS)
    return main, meta
