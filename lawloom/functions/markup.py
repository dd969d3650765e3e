"""Flat HTML reading inside one row: a page stays in its row, so nothing is shuffled.

A piece runs from an opening tag to the next opening tag of the same kind; end tags that
are missing in malformed pages therefore never swallow what follows.
"""

from pyspark.sql import Column
from pyspark.sql import functions as F

from lawloom.functions.arrays import CUT, bind, running_sum
from lawloom.functions.text import collapse, decode_entities, strip, unescape

NOT_CONTENT = r"(?is)<(?:(script|style)\b.*?</\1\s*>|!--.*?-->|!doctype[^>]*>)"
TAG = r"<(/?)([A-Za-z][A-Za-z0-9]*)([^>]*)>([^<]*)"
BLOCK_EDGE = (
    r"(?i)</?(?:p|div|table|thead|tbody|tr|td|th|ul|ol|li|dl|dt|dd|section|article|h[1-6]|form|body|html)\b"
)
# Runs of \s that are not already one plain blank.
BLANKS = r"\s(?:(?<=[^ ])\s*+|\s++)"
# Line separators are white space in page text, so they are free to serve as group marks.
MARK_A, MARK_B, FIELD = "\x1c", "\x1d", "\x0b"


def prepare(html: Column) -> Column:
    """Scripts, styles, comments and doctype out; entities decoded but for those of markup itself; control characters to blanks."""
    body = bind(F.regexp_replace(F.coalesce(html, F.lit("")), NOT_CONTENT, ""), decode_entities)
    return F.regexp_replace(body, r"[\x0b\x0c\x1c\x1d\x1e\x1f\x85]", " ")


def tag_tokens(html: Column) -> Column:
    """array<struct<is_close,tag,attrs,text>>; text is what follows the tag."""
    found = F.regexp_extract_all(prepare(html), F.lit(TAG), F.lit(0))
    return F.transform(
        found,
        lambda t: F.struct(
            (F.regexp_extract(t, TAG, 1) == "/").alias("is_close"),
            F.lower(F.regexp_extract(t, TAG, 2)).alias("tag"),
            F.trim(F.regexp_extract(t, TAG, 3)).alias("attrs"),
            F.regexp_extract(t, TAG, 4).alias("text"),
        ),
    )


def opens(names: str) -> str:
    """Pattern of an opening tag; `names` may be an alternation."""
    return rf"<(?:{names})(?=[\s>/])"


def cut_at(html: Column, pattern: str) -> Column:
    """Parts of the text that begin where the pattern matches; what comes before is left out.

    `split` would compile its pattern for every value; `regexp_replace` keeps it, and splitting at
    one plain character needs none.
    """
    return F.slice(F.split(F.regexp_replace(html, pattern, CUT + "$0"), CUT), 2, 1 << 30)


def until(text: Column, pattern: str) -> Column:
    """Text up to the first match."""
    return F.substring_index(F.regexp_replace(text, pattern, CUT), CUT, 1)


def pieces(html: Column, names: str) -> Column:
    """Parts of the text that begin at an opening tag of `names`."""
    return cut_at(html, rf"(?i){opens(names)}")


def after_open(piece: Column) -> Column:
    return F.substr(piece, F.instr(piece, ">") + 1)


def open_tag(piece: Column) -> Column:
    return F.regexp_extract(piece, r"^(<[^>]*>)", 1)


def block(piece: Column) -> Column:
    """Inside of a paragraph-like piece, up to the first block edge."""
    return until(after_open(piece), BLOCK_EDGE)


def inside(piece: Column, name: str) -> Column:
    """Inside of a piece, up to its end tag when there is one."""
    return until(after_open(piece), rf"(?i)</{name}\s*>")


def flow_text(fragment: Column) -> Column:
    """Text with a blank for every tag."""
    return collapse(unescape(F.regexp_replace(fragment, r"<[^>]*>", " ")))


def plain_text(fragment: Column) -> Column:
    """Text with tags removed and nothing put in their place."""
    return collapse(unescape(F.regexp_replace(fragment, r"<[^>]*>", "")))


def line_text(fragment: Column) -> Column:
    """Text as a reader sees it: block edges and <br> break the line."""
    broken = F.regexp_replace(fragment, BLANKS, " ")
    broken = F.regexp_replace(broken, r"(?i)</?(?:br|p|div|tr|li|ul|ol|h[1-6])\b[^>]*>", "\n")
    return unescape(F.regexp_replace(broken, r"<[^>]*>", ""))


def node_lines(fragment: Column) -> Column:
    """Every text node trimmed and on its own line, blank nodes left out."""
    nodes = F.transform(F.split(fragment, r"<[^>]*>"), lambda t: strip(unescape(t)))
    return F.array_join(F.filter(nodes, lambda t: t != ""), "\n")


def attribute(tag: Column, name: str) -> Column:
    return unescape(F.regexp_extract(tag, rf"(?is)\s{name}\s*=\s*[\"']?([^\"'>]*)", 1))


def class_token(token: str) -> str:
    """Pattern, inside an opening tag, of one class among others; `token` is a pattern."""
    return rf"[^>]*\sclass\s*=\s*[\"']?(?:[^\"'>]*\s)?(?:{token})(?=[\s\"'>])"


def cells(row: Column) -> Column:
    """array<struct<tag,raw>>: the cells of one table row, `raw` their inside."""
    return F.transform(
        pieces(row, "td|th"),
        lambda p: F.struct(
            F.lower(F.substring(p, 2, 2)).alias("tag"),
            until(after_open(p), r"(?i)</t(?:[dhr]|able|body|head)\s*>").alias("raw"),
        ),
    )


def raw_of(row_cells: Column, tag: str) -> Column:
    """Raw insides of the cells of one kind."""
    return F.transform(F.filter(row_cells, lambda c: c.tag == tag), lambda c: c.raw)


def cells_of(row: Column, tag: str) -> Column:
    return raw_of(cells(row), tag)


def outer_cells(fragment: Column) -> Column:
    """Raw insides of the cells of outermost tables, nested tables included.

    Depth counts table tags only; a cell ends at its end tag or at the next cell or row of
    the same table.
    """

    def marked(p, depth):
        edges = r"(?i)</t(?:d|r|h|body|head|foot)\s*>|<(?:tr|th|tbody)\b[^>]*>"
        own = F.regexp_replace(F.regexp_replace(p, edges, MARK_B + "$0"), r"(?i)<td\b[^>]*>", MARK_A)
        closed = (depth <= 0) & p.rlike(r"(?i)^</table\b")
        return F.when(depth == 1, own).when(closed, F.concat(F.lit(MARK_B), p)).otherwise(p)

    parts = cut_at(fragment, r"(?i)</?table\b")
    joined = bind(parts, lambda ps: F.array_join(F.zip_with(ps, running_sum(steps(ps, "table")), marked), ""))
    return F.transform(runs_after(joined, MARK_A), lambda r: F.substring_index(r, MARK_B, 1))


def steps(parts: Column, names: str) -> Column:
    """+1 for a part that begins with an opening tag of `names`, -1 for a closing one, else 0. Names have at most 14 letters."""
    return F.transform(
        parts,
        lambda p: F.when(F.substring(p, 1, 17).rlike(rf"(?i)^<(?:{names})\b"), F.lit(1))
        .when(F.substring(p, 1, 17).rlike(rf"(?i)^</(?:{names})\b"), F.lit(-1))
        .otherwise(F.lit(0)),
    )


def runs_after(tagged: Column, mark: str) -> Column:
    """What follows each mark; text before the first one is left out."""
    return bind(F.split(tagged, mark), lambda r: F.slice(r, F.lit(2), F.size(r)))
