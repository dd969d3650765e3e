"""Law text to chapter / article / clause rows, inside the row that holds the text.

A document that arrives as one cell is cut with array and string functions only: the plan is
scan -> project -> generate, with no exchange, however large the table is.

Lines are tagged with marks and rejoined, then the text is split again at those marks. Line
breaks never occur inside a line, so line-break characters are free to serve as marks. Nested
splits carry state: splitting by article first gives every boundary its article, splitting by
chapter first gives the same boundaries, in the same order, their chapter.
"""

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lawloom import constants as C
from lawloom.functions.arrays import bind, exploded, split_before
from lawloom.functions.clauses import split_clause_start
from lawloom.functions.text import blank_to_null, lines_of, strip

FIELD, PLAIN, CANDIDATE = "\x0b", "\x0c", "\r"
ARTICLE, CHAPTER, CLAUSE = "\x1c", "\x1d", "\x1e"


@dataclass(frozen=True)
class Rules:
    """Which lines open what.

    strict_article: a heading is the whole line (page text); otherwise a prefix (paragraphs).
    gap_limit: reject a heading whose number is further than this from the last accepted one.
    keep_preamble: keep body text before the first article.
    drop_page_lines: drop law name, publisher and page-number lines.
    inline_body: accept headings that are followed by body text on the same line.
    branch_articles: also accept 제N조의M.
    keep_heading_body: keep body text that follows a titled heading on its line.
    """

    strict_article: bool = True
    gap_limit: int | None = C.ARTICLE_GAP_LIMIT
    keep_preamble: bool = False
    drop_page_lines: bool = True
    inline_body: bool = False
    branch_articles: bool = False
    keep_heading_body: bool = True


PAGE_RULES = Rules()
PARAGRAPH_RULES = Rules(strict_article=False, gap_limit=None, keep_preamble=True, drop_page_lines=False)
PARAGRAPH_RULES_COMPAT = Rules(
    strict_article=False, gap_limit=None, keep_preamble=True, drop_page_lines=False, keep_heading_body=False
)


def is_page_line(line: Column, law_name: Column) -> Column:
    """Running header or footer: law name alone, publisher, page number."""
    return line.eqNullSafe(law_name) | line.rlike("|".join(C.PUBLISHER_NAMES)) | line.rlike(r"^\p{Nd}+\z")


def law_lines(text: Column, law_name: Column, drop_page_lines: bool = True) -> Column:
    """Array of kept lines of a page text."""
    lines = lines_of(text)
    return F.filter(lines, lambda l: ~is_page_line(l, law_name)) if drop_page_lines else lines


def is_chapter(line: Column) -> Column:
    return line.rlike(C.CHAPTER_PATTERN)


def _branch(rules: Rules) -> str:
    return r"(?:의\p{Nd}+)?" if rules.branch_articles else ""


def is_heading(line: Column, rules: Rules = PAGE_RULES) -> Column:
    number = rf"^제{C.WS}*\p{{Nd}}+{C.WS}*조{_branch(rules)}"
    if not rules.strict_article:
        return line.rlike(number)
    whole = line.rlike(rf"{number}(?:{C.WS}*\(.*?\))?{C.WS}*$")
    return whole | line.rlike(rf"{number}\(.+?\)") if rules.inline_body else whole


def heading_parts(line: Column, rules: Rules = PAGE_RULES) -> tuple[Column, Column, Column]:
    """(article number, title, body) of a heading line; '' where there is none."""
    branch = rf"({_branch(rules)})"
    if rules.strict_article:
        pattern = rf"^제{C.WS}*(\p{{Nd}}+){C.WS}*조{branch}(?:\((.+?)\))?{C.WS}*(.*)$"
    else:
        pattern = rf"^제(\p{{Nd}}+)조{branch}(?:\((.*?)\))?{C.WS}*(.*)$"

    def part(k):
        return F.regexp_extract(line, pattern, k)

    matched = line.rlike(pattern)
    number = F.when(matched, F.concat(F.lit("제"), part(1), F.lit("조"), part(2))).otherwise(
        line if rules.strict_article else F.lit("")
    )
    rest = strip(part(4))
    titled = part(3) != ""
    title = F.when(titled, strip(part(3))).otherwise(rest)
    body = F.when(titled, rest).otherwise(F.lit(""))
    return number, title, body if rules.keep_heading_body else F.lit("")


def heading_number(line: Column) -> Column:
    """First number of a line; full-width digits count. Numbers too long for 64 bits count as one and the same, larger than all others."""
    digits = F.translate(F.regexp_extract(line, r"(\p{Nd}+)", 1), "０１２３４５６７８９", "0123456789")
    return bind(digits, lambda d: F.coalesce(d.try_cast("bigint"), F.when(d.rlike(r"^[0-9]{19,}\z"), F.lit(2**62))))


def accepted_flags(numbers: Column, entry: Column, gap_limit: int | None) -> Column:
    """For heading numbers in order: '1' accepted, '0' rejected; the last accepted number moves along."""

    def step(state, n):
        ok = state.last.isNull() | n.isNull() | (F.abs(n - state.last) <= gap_limit)
        return F.struct(
            F.when(ok, F.coalesce(n, state.last)).otherwise(state.last).alias("last"),
            F.concat(state.flags, F.when(ok, F.lit("1")).otherwise(F.lit("0"))).alias("flags"),
        )

    start = F.struct(entry.cast("bigint").alias("last"), F.lit("").alias("flags"))
    return F.aggregate(numbers, start, step)


def _tag_line(line: Column, rules: Rules) -> Column:
    mark, rest = split_clause_start(line)
    return (
        F.when(is_chapter(line), F.concat(F.lit(CHAPTER), line, F.lit(FIELD)))
        .when(is_heading(line, rules), F.concat(F.lit(CANDIDATE), line))
        .when(mark.isNotNull(), F.concat(F.lit(CLAUSE), mark, F.lit(FIELD), rest))
        .otherwise(F.concat(F.lit(PLAIN), line))
    )


def _tag_heading(line: Column, rules: Rules) -> Column:
    number, title, body = heading_parts(line, rules)

    def tail(b):
        plain = F.concat(F.lit(PLAIN), b)
        if not rules.strict_article:
            return plain
        mark, rest = split_clause_start(b)
        return F.when(mark.isNotNull(), F.concat(F.lit(CLAUSE), mark, F.lit(FIELD), rest)).otherwise(plain)

    return F.concat(F.lit(ARTICLE), number, F.lit(FIELD), title, F.lit(FIELD), bind(body, tail))


def _leaf_text(leaf: Column) -> Column:
    return strip(F.replace(F.substring_index(leaf, FIELD, -1), F.lit(PLAIN), F.lit(" ")))


def _header_field(piece: Column, k: int) -> Column:
    """k-th field of a tagged piece, its mark left out; reads no further than that field."""
    if k == 1:
        return F.substring(F.substring_index(piece, FIELD, 1), 2, 2147483647)
    return F.substring_index(F.substring_index(piece, FIELD, k), FIELD, -1)


def marked_lines(lines: Column, rules: Rules) -> Column:
    """Every line with the mark of what it opens; headings are candidates."""
    return F.transform(lines, lambda l: _tag_line(l, rules))


def joined_lines(marked: Column) -> Column:
    return F.concat(F.lit(FIELD), F.array_join(marked, ""))


def joined_outline(marked: Column) -> Column:
    """joined_lines without texts: chapters, headings and clause marks only."""

    def opened(m):
        clause = F.concat(F.substring_index(m, FIELD, 1), F.lit(FIELD))
        return F.when(F.startswith(m, F.lit(PLAIN)), F.lit("")).when(F.startswith(m, F.lit(CLAUSE)), clause).otherwise(m)

    return joined_lines(F.transform(marked, opened))


def candidate_numbers(parts: Column) -> Column:
    """Numbers of the heading candidates; `parts` is a joined text split before them."""
    return F.transform(F.slice(parts, F.lit(2), F.size(parts)), heading_number)


def with_tagged_text(df: DataFrame, lines: str, rules: Rules, entry: Column | None = None) -> DataFrame:
    """Adds `_tagged` (one string with marks) and `_last` (last accepted number)."""
    return with_resolved_text(df.withColumn("_joined", joined_lines(marked_lines(F.col(lines), rules))), rules, entry)


def with_resolved_text(df: DataFrame, rules: Rules, entry: Column | None = None) -> DataFrame:
    """with_tagged_text of lines that are marked and joined already, in `_joined`."""
    start = entry if entry is not None else F.lit(None)
    df = df.withColumn("_parts", split_before(F.col("_joined"), CANDIDATE))
    if rules.gap_limit is None:
        fold = F.struct(F.lit(None).cast("bigint").alias("last"), F.lit("").alias("flags"))
    else:
        fold = accepted_flags(candidate_numbers(F.col("_parts")), start, rules.gap_limit)
    df = df.withColumn("_fold", fold).withColumn("_flags", F.split("_fold.flags", ""))

    def resolve(part, ok):
        after = F.substring(part, 2, 2147483647)
        heading = bind(
            F.regexp_extract(after, f"^[^{PLAIN}{CHAPTER}{CLAUSE}]*", 0),
            lambda line: F.concat(_tag_heading(line, rules), F.substr(after, F.length(line) + 1)),
        )
        if rules.gap_limit is not None:
            heading = F.when(ok == "1", heading).otherwise(F.concat(F.lit(PLAIN), after))
        return F.when(F.startswith(part, F.lit(CANDIDATE)), heading).otherwise(part)

    flags = F.concat(F.array(F.lit("")), F.col("_flags"))
    resolved = F.array_join(
        F.zip_with("_parts", F.slice(flags, F.lit(1), F.size("_parts")), resolve), ""
    )
    return df.withColumn("_tagged", resolved).withColumn("_last", F.col("_fold.last"))


def _drop_text_before_first_article(tagged: Column, seen: Column) -> Column:
    before = F.substring_index(tagged, ARTICLE, 1)
    kept = F.regexp_replace(before, f"{PLAIN}[^{PLAIN}{CHAPTER}{CLAUSE}]*", "")
    return F.when(seen, tagged).otherwise(F.concat(kept, F.substr(tagged, F.length(before) + 1)))


def with_row_array(df: DataFrame, carried: dict[str, Column] | None = None) -> DataFrame:
    """Adds `_rows`: array<struct> of one document (or block) in output order.

    `carried` holds the state that precedes the text: chapter, article_number, article_title
    and mark; nothing precedes a whole document.
    """
    none = F.lit(None).cast("string")
    state = {k: none for k in ("chapter", "article_number", "article_title", "mark")} | (carried or {})
    tagged = F.col("_tagged")

    def article_of(piece):
        opened = F.startswith(piece, F.lit(ARTICLE))
        return F.struct(
            F.when(opened, blank_to_null(_header_field(piece, 1))).otherwise(state["article_number"]).alias("number"),
            F.when(opened, blank_to_null(_header_field(piece, 2))).otherwise(state["article_title"]).alias("title"),
        )

    def chapter_of(piece):
        return F.when(F.startswith(piece, F.lit(CHAPTER)), _header_field(piece, 1)).otherwise(state["chapter"])

    def mark_of(piece, article):
        first = F.when(~F.startswith(article, F.lit(ARTICLE)), state["mark"])
        return F.when(F.startswith(piece, F.lit(CLAUSE)), _header_field(piece, 1)).otherwise(first)

    def marks_in(article):
        later = F.flatten(
            F.transform(
                split_before(article, CLAUSE),
                lambda k: F.transform(
                    F.filter(split_before(k, CHAPTER), lambda p: F.startswith(p, F.lit(CHAPTER))),
                    lambda p: mark_of(k, article),
                ),
            )
        )
        return F.concat(F.array(F.when(~F.startswith(article, F.lit(ARTICLE)), state["mark"])), later)

    df = (
        df.withColumn("_bounds", split_before(tagged, ARTICLE, CHAPTER))
        .withColumn(
            "_arts",
            F.flatten(
                F.transform(
                    split_before(tagged, ARTICLE),
                    lambda a: F.transform(split_before(a, CHAPTER), lambda p: article_of(a)),
                )
            ),
        )
        .withColumn(
            "_chaps",
            F.flatten(
                F.transform(
                    split_before(tagged, CHAPTER),
                    lambda c: F.transform(split_before(c, ARTICLE), lambda p: chapter_of(c)),
                )
            ),
        )
        .withColumn("_marks", F.flatten(F.transform(split_before(tagged, ARTICLE), marks_in)))
    )

    def rows_of(z):
        return bind(split_before(z["_bounds"], CLAUSE), lambda leaves: leaf_rows(z, leaves))

    def leaf_rows(z, leaves):
        clauses = F.transform(
            F.slice(leaves, F.lit(2), F.size(leaves)),
            lambda k, i: F.struct(_header_field(k, 1).alias("mark"), _leaf_text(k).alias("text"), (i + 1).alias("leaf")),
        )
        head = F.array(
            F.struct(z["_marks"].alias("mark"), _leaf_text(F.get(leaves, F.lit(0))).alias("text"), F.lit(0).alias("leaf"))
        )
        ordered = F.when(z["_marks"].isNull(), F.concat(clauses, head)).otherwise(F.concat(head, clauses))
        return F.transform(
            F.filter(ordered, lambda r: r.text != ""),
            lambda r: F.struct(
                z["_chaps"].alias("chapter"),
                z["_arts"]["number"].alias("article_number"),
                z["_arts"]["title"].alias("article_title"),
                r.mark.alias("clause_number"),
                r.text.alias("text"),
                z["_no"].alias("bound"),
                r.leaf.alias("leaf"),
            ),
        )

    zipped = F.arrays_zip(
        F.col("_bounds"), F.col("_arts"), F.col("_chaps"), F.col("_marks"),
        F.sequence(F.lit(0), F.size("_bounds") - 1).alias("_no"),
    )
    return df.withColumn("_rows", F.flatten(F.transform(zipped, rows_of)))


def segment(
    df: DataFrame, law_name: str = "law_name", text: str = "text", rules: Rules = PAGE_RULES, keys: tuple[str, ...] = ()
) -> DataFrame:
    """One row per chapter/article/clause text of every document.

    Output: keys, law_name, ord (0..n-1 in reading order of the rows), chapter,
    article_number, article_title, clause_number, text.
    """
    lines = df.select(
        *keys, F.col(law_name).alias("law_name"), law_lines(F.col(text), F.col(law_name), rules.drop_page_lines).alias("_lines")
    )
    tagged = with_tagged_text(lines, "_lines", rules).select(*keys, "law_name", "_tagged")
    if not rules.keep_preamble:
        tagged = tagged.withColumn("_tagged", _drop_text_before_first_article(F.col("_tagged"), F.lit(False)))
    return (
        exploded(with_row_array(tagged), [*keys, "law_name"], "_rows", "ord", "_row")
        .select(
            *keys,
            "law_name",
            "ord",
            *[F.col(f"_row.{c}").alias(c) for c in C.LAW_ROW_COLUMNS if c != "law_name"],
        )
    )


def rejects(df: DataFrame, law_name: str = "law_name", text: str = "text") -> DataFrame:
    """Documents that have no text to cut, with the reason."""
    reason = F.when(F.col(text).isNull(), "no text").when(strip(F.col(text)) == "", "blank text")
    return df.select(F.col(law_name).alias("key"), F.lit("failed").alias("status"), reason.alias("error")).where(
        F.col("error").isNotNull()
    )
