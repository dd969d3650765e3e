"""Law pages in HTML to article, clause and supplementary rows, inside the page's row."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lawloom import constants as C
from lawloom.functions.arrays import bind, exploded, running_sum, split_before
from lawloom.functions.clauses import clause_array, clause_label, full_text
from lawloom.functions.markup import (
    FIELD, MARK_A, MARK_B, block, class_token, cut_at, flow_text, pieces, plain_text, prepare, steps,
)
from lawloom.functions.text import collapse, remove_once

GROUP = rf"(?i)<div{class_token('pgroup')}"


def own_part(group: Column) -> Column:
    """A group up to the end tag of its div; up to the next group when that tag is missing."""

    def closed(parts):
        return bind(F.array_position(running_sum(steps(parts, "div")), F.lit(0)), lambda at: up_to(parts, at))

    def up_to(parts, at):
        return F.array_join(F.when(at > 0, F.slice(parts, F.lit(1), (at - 1).cast("int"))).otherwise(parts), "")

    return bind(cut_at(group, r"(?i)</?div\b"), closed)


def _with_class(paragraphs: Column, token: str) -> Column:
    return F.filter(paragraphs, lambda p: p.rlike(rf"(?i)^<p{class_token(token)}"))


def _spans(fragment: Column, token: str) -> Column:
    return F.regexp_extract_all(fragment, F.lit(rf"(?is)<span{class_token(token)}[^>]*>(.*?)</span\s*>"), F.lit(1))


def _law_row(section, chapter, number, title, clause, text) -> Column:
    values = dict(
        section=section, chapter=chapter, article_number=number, article_title=title, clause_number=clause, text=text
    )
    return F.struct(*[v.alias(k) for k, v in values.items()])


def _no_rows() -> Column:
    return F.array().cast(
        "array<struct<section:string,chapter:string,article_number:string,article_title:string,"
        "clause_number:string,text:string>>"
    )


def group_title(group: Column) -> Column:
    """Chapter title of a group or NULL; supplementary groups have none."""
    paragraphs = pieces(group, "p")
    titled = F.concat(_with_class(paragraphs, r"[^\s\"'>]*pty1_tit[^\s\"'>]*"), _with_class(paragraphs, "gtit"))
    return bind(
        F.get(titled, F.lit(0)), lambda t: F.when(t.isNotNull() & ~is_supplement(group), plain_text(block(t)))
    )


def is_supplement(group: Column) -> Column:
    return group.rlike(rf"(?i)<p{class_token('pty3')}")


def article_rows(group: Column, chapter: Column) -> Column:
    """Clause rows of an article group; none when its header is not an article."""
    is_header = rf"(?i)^<p{class_token('pty1_p4')}"

    def of_paragraphs(ps):
        first = F.array_position(F.transform(ps, lambda p: p.rlike(is_header)), F.lit(True))
        return bind(first, lambda k: F.when(k > 0, bind(block(F.try_element_at(ps, k.cast("int"))), lambda h: of_header(ps, k, h))))

    def of_header(ps, k, header):
        label = F.regexp_extract(header, r"(?is)<label\b[^>]*>(.*?)</label\s*>", 1)
        heading = plain_text(F.when(header.rlike(r"(?i)<label\b"), label).otherwise(header))
        return bind(heading, lambda h: of_heading(ps, k, header, h))

    def of_heading(ps, k, header, heading):
        others = F.transform(F.filter(ps, lambda p, i: i + 1 != k), lambda p: flow_text(block(p)))
        body = F.concat(F.array(remove_once(plain_text(header), heading)), others)
        number = F.regexp_extract(heading, C.HTML_ARTICLE_PATTERN, 1)
        title = F.regexp_extract(heading, C.HTML_ARTICLE_PATTERN, 2)
        rows = F.transform(
            clause_array(F.array_join(body, " ")),
            lambda c: _law_row(F.lit(C.MAIN_SECTION), chapter, number, title, clause_label(c.mark), c.text),
        )
        return F.when(number != "", rows)

    return F.coalesce(bind(pieces(group, "p"), of_paragraphs), _no_rows())


def supplement_rows(group: Column) -> Column:
    """Per supplementary paragraph one full-text row, then its clauses with raw marks."""
    section = F.lit(C.SUPPLEMENT_SECTION)

    def of_paragraphs(ps):
        spans = F.transform(_spans(block(F.get(_with_class(ps, "pty3"), F.lit(0))), "sfon"), plain_text)

        def named(s):
            info = F.trim(F.coalesce(F.get(s, F.lit(0)), F.lit("")), F.lit("<>"))
            return collapse(F.concat_ws(" ", info, F.get(s, F.lit(1))))

        dated = _with_class(ps, r"[^\s\"'>]*pty3_dep[0-9]+[^\s\"'>]*")
        return bind(bind(spans, named), lambda chapter: F.flatten(F.transform(dated, lambda p: of_paragraph(p, chapter))))

    def of_paragraph(p, chapter):
        def of_inner(inner):
            header = F.get(_spans(inner, "bl"), F.lit(0))
            heading = F.coalesce(F.when(header.isNotNull(), plain_text(header)), flow_text(inner))
            return bind(heading, lambda h: of_heading(inner, header.isNotNull(), h))

        def of_heading(inner, marked, heading):
            body = F.when(marked, remove_once(plain_text(inner), heading)).otherwise(heading)
            rows = bind(clause_array(body), lambda clauses: of_clauses(heading, clauses))
            return F.when(heading.rlike(C.HTML_ARTICLE_PATTERN), rows).otherwise(_no_rows())

        def of_clauses(heading, clauses):
            number = F.regexp_extract(heading, C.HTML_ARTICLE_PATTERN, 1)
            title = F.regexp_extract(heading, C.HTML_ARTICLE_PATTERN, 2)
            whole = _law_row(section, chapter, number, title, F.lit(C.FULL_TEXT_MARK), full_text(clauses))
            marked = F.transform(
                clauses, lambda c: _law_row(section, chapter, number, title, F.coalesce(c.mark, F.lit("")), c.text)
            )
            return F.concat(F.array(whole), marked)

        return bind(block(p), of_inner)

    return bind(pieces(group, "p"), of_paragraphs)


def law_html_rows(df: DataFrame, law_name: str = "law_name", html: str = "html", keys: tuple[str, ...] = ()) -> DataFrame:
    """Rows of every law page in page order; law_name is the requested name."""
    groups = F.transform(cut_at(prepare(F.col(html)), GROUP), own_part)
    tagged = F.array_join(
        F.transform(
            groups,
            lambda g: F.concat(
                F.coalesce(F.concat(F.lit(MARK_B), group_title(g), F.lit(FIELD)), F.lit("")), F.lit(MARK_A), g
            ),
        ),
        "",
    )

    def in_chapter(part):
        titled = F.startswith(part, F.lit(MARK_B))
        chapter = F.when(titled, F.substring(F.substring_index(part, FIELD, 1), 2, 2147483647)).otherwise("")
        members = split_before(part, MARK_A)
        return F.transform(
            F.filter(members, lambda g: F.startswith(g, F.lit(MARK_A))),
            lambda g: F.struct(chapter.alias("chapter"), F.substring(g, 2, 2147483647).alias("html")),
        )

    pages = df.select(*keys, F.col(law_name).alias("law_name"), tagged.alias("_tagged"))
    placed = pages.select(
        *keys, "law_name", F.flatten(F.transform(split_before(F.col("_tagged"), MARK_B), in_chapter)).alias("_groups")
    )
    rows = exploded(
        placed,
        [*keys, "law_name"],
        F.flatten(
            F.transform(
                "_groups",
                lambda g: F.when(is_supplement(g.html), supplement_rows(g.html)).otherwise(article_rows(g.html, g.chapter)),
            )
        ),
        "ord",
        "_row",
    )
    return rows.select(
        *keys, "law_name", "ord", *[F.col(f"_row.{c}").alias(c) for c in C.LAW_HTML_COLUMNS if c != "law_name"]
    )
