"""Element intervals of a page: where each element begins and ends, from one pass with a stack of open elements.

A page is cut at the tags of the named elements; tag number b (from 1) opens an element that ends before tag number e, so the
parts b to e-1 are its markup, whatever stands in it. An element is an ancestor of another when its interval holds the other's.

Ends that a page leaves out are supplied as the HTML standard does: a cell ends at the next cell or row of its table, a row at the
next row or row group, a list entry at the next entry of its list; an end tag closes what is open inside its element, but those of
blocks never reach out of a cell and those of cells and rows never out of their table; an end tag without an open element is
ignored; what is still open at the end of the page ends there. The pass is one fold over the tags, in chunks, and a page stays in its
row.
"""

from pyspark.sql import Column
from pyspark.sql import functions as F

from lawloom.functions.arrays import CUT, bind
from lawloom.functions.markup import after_open, cut_at, runs_after

GROUPS = ("thead", "tbody", "tfoot")
CELLS = ("td", "th")
# An opening tag ends the open elements of these names, inside the nearest open element of the third column.
IMPLIED = {
    **{n: (CELLS, ("table",)) for n in CELLS},
    "tr": (("tr", *CELLS), ("table",)),
    **{n: ((*GROUPS, "tr", *CELLS), ("table",)) for n in GROUPS},
    "li": (("li",), ("ul", "ol", *CELLS, "table")),
    "dt": (("dt", "dd"), ("dl", *CELLS, "table")),
    "dd": (("dt", "dd"), ("dl", *CELLS, "table")),
}
# Right inside these nothing is left to end: the parent's own opening tag has ended it.
USUAL_PARENTS = {
    **{n: ("tr",) for n in CELLS}, "tr": (*GROUPS, "table"), **{n: ("table",) for n in GROUPS}, "li": ("ul", "ol"), "dt": ("dl",), "dd": ("dl",),
}
# End tags of these reach as far as to the nearest open table; those of OPEN_SCOPE to the whole page; all others to the cell.
TABLE_SCOPE = (*CELLS, "tr", *GROUPS)
OPEN_SCOPE = ("table", "body", "html")
CHUNK = 256


def tag_parts(page: Column, names: list[str]) -> Column:
    """Parts of the page, each beginning at an opening or closing tag of one of `names`."""
    return cut_at(page, rf"(?i)</?(?:{'|'.join(names)})(?=[\s>/])")


def _nearest(tags: Column, names) -> Column:
    """Place of the innermost open element of one of `names`, 1 for the innermost of all; NULL when there is none."""
    places = [F.nullif(F.array_position(tags, F.lit(n)), F.lit(0)) for n in names]
    return F.least(*places) if len(places) > 1 else places[0]


def _ended(tags: Column, name: Column, close: Column, names: list[str]) -> Column:
    """Number of open elements that a tag ends; `tags` has the innermost first."""

    def within(limit_names, wanted):
        known = [n for n in limit_names if n in names]
        limit = F.coalesce(_nearest(tags, known), F.lit(1 << 30)) if known else F.lit(1 << 30)
        return bind(limit, lambda end: F.greatest(*[
            F.when(place < end, place).otherwise(F.lit(0)) for place in (F.array_position(tags, w) for w in wanted)
        ], F.lit(0)))

    top = F.get(tags, F.lit(0))
    by_end = (
        F.when(top == name, F.lit(1).cast("bigint"))
        .when(name.isin(*OPEN_SCOPE), F.array_position(tags, name))
        .when(name.isin(*TABLE_SCOPE), within(("table",), [name]))
        .otherwise(within((*CELLS, "table"), [name]))
    )
    by_open = F.lit(0).cast("bigint")
    for opening, (wanted, scope) in IMPLIED.items():
        known = [F.lit(w) for w in wanted if w in names]
        if opening in names and known:
            none_open = top.isin(*USUAL_PARENTS[opening])
            by_open = F.when(name == opening, F.when(none_open, F.lit(0).cast("bigint")).otherwise(within(scope, known))).otherwise(by_open)
    return F.when(close, by_end).otherwise(by_open).cast("int")


def elements(
    parts: Column, names: list[str], chains: list[list[str]] = [], only: list[str] | None = None, inert: str | None = None
) -> Column:
    """array<struct<begin,end,parent,depth,tag,hit>> in page order; `parent` is the parent's `begin`, 0 at the top.

    chains: at most seven descendant paths such as ["form", "table", "td"], of up to 127 names. hit[k] says that the element
    completes path k, outermost first, so that an element within one that was hit is not hit again. only: give just
    the elements of these names and those that were hit. inert: pattern of tags, each written as `name number;` or `/name number;`, that
    end nothing, complete no path and leave open what was open; the fold passes over them, but for those of the pattern's first group. A page that is absent or has no such tags has no elements. Names have at most 14 letters.
    """
    names = [n.lower() for n in names]
    no_texts, no_numbers = F.array().cast("array<string>"), F.array().cast("array<bigint>")

    def token(part, i):
        name = F.lower(F.regexp_extract(F.substring(part, 1, 16), r"^</?([A-Za-z0-9]+)", 1))
        return F.struct((i + 1).cast("bigint").alias("at"), name.alias("name"), F.startswith(part, F.lit("</")).alias("close"))

    def without_inert(parts):
        def word(part, i):
            return F.concat((i + 1).cast("string"), F.substring(part, 1, 16), F.lit(CUT))

        def of_words(words):
            name = F.get(words, F.lit(0))
            close = F.startswith(name, F.lit("/"))
            return F.struct(
                F.get(words, F.lit(1)).cast("bigint").alias("at"), F.when(close, F.substring(name, 2, 16)).otherwise(name).alias("name"), close.alias("close"))

        written = F.lower(F.regexp_replace(F.array_join(F.transform(parts, word), ""), rf"(\d++)<(/?[A-Za-z0-9]++)[^{CUT}]*+{CUT}", "$2 $1;"))
        left = bind(F.split(F.regexp_replace(written, inert, "$1"), ";"), lambda w: F.slice(w, F.lit(1), F.size(w) - 1))
        return F.transform(left, lambda w: bind(F.split(w, " "), of_words))

    # Spark copies a fold's state at every step: open elements are kept in flat arrays, ended ones in one text.
    def state(tags, at, way, done):
        return F.struct(tags.alias("tags"), at.alias("at"), way.alias("way"), done.alias("done"))

    def way_on(before, name):
        """A byte per path: how much of it was gone through, and 128 where this element completes it."""
        total = F.lit(0).cast("bigint")
        for k, chain in enumerate(chains):
            gone = F.shiftright(before, 8 * k).bitwiseAND(F.lit(127))
            is_next = F.coalesce(F.get(F.array(*[F.lit(c) for c in chain]), gone.cast("int")) == name, F.lit(False))
            byte = F.when(is_next, gone + 1 + F.when(gone == len(chain) - 1, F.lit(128)).otherwise(F.lit(0))).otherwise(gone)
            total = total + F.shiftleft(byte.cast("bigint"), 8 * k)
        return total

    def ended_texts(s, n, end):
        """`;begin end parent depth tag way` for each of the n innermost open elements."""
        def one(i):
            values = (F.get(s["at"], i), end, F.coalesce(F.get(s["at"], i + 1), F.lit(0)), F.size(s["at"]) - i, F.get(s["tags"], i), F.get(s["way"], i))
            text = F.concat(F.lit(";"), F.concat_ws(" ", *[v.cast("string") for v in values]))
            if only is None:
                return text
            was_hit = F.get(s["way"], i).bitwiseAND(F.lit(sum(128 << 8 * k for k in range(len(chains))))) != 0
            return F.when(was_hit | F.get(s["tags"], i).isin(*only), text).otherwise("")

        return F.array_join(F.transform(F.sequence(F.lit(0), n - 1), one), "")

    def step(s, t):
        def left(stack, n, entry):
            kept = F.when(n == 0, stack).otherwise(F.slice(stack, n + 1, F.size(stack)))
            return F.when(t["close"], kept).otherwise(F.concat(F.array(entry), kept))

        def after(n):
            way = way_on(F.coalesce(F.get(s["way"], n), F.lit(0).cast("bigint")), t["name"])
            done = F.when(n == 0, s["done"]).otherwise(F.concat(s["done"], ended_texts(s, n, t["at"])))
            return state(left(s["tags"], n, t["name"]), left(s["at"], n, t["at"]), left(s["way"], n, way), done)

        return bind(_ended(s["tags"], t["name"], t["close"], names), after)

    def element(text):
        def of_values(v):
            def number(i):
                return F.get(v, F.lit(i)).cast("int")

            def hit(k):
                return F.shiftright(F.get(v, F.lit(5)).cast("bigint"), 8 * k).bitwiseAND(F.lit(128)) > 0

            hits = F.array(*[hit(k) for k in range(len(chains))]) if chains else F.array().cast("array<boolean>")
            return F.struct(
                number(0).alias("begin"), number(1).alias("end"), number(2).alias("parent"), number(3).alias("depth"),
                F.get(v, F.lit(4)).alias("tag"), hits.alias("hit"),
            )

        return bind(F.split(text, " "), of_values)

    def folded(tokens, last):
        chunks = F.sequence(F.lit(0), F.floor((F.greatest(F.size(tokens), F.lit(1)) - 1) / CHUNK).cast("int"))

        def over(s, k):
            inner = F.aggregate(F.slice(tokens, k * CHUNK + 1, F.lit(CHUNK)), state(s["tags"], s["at"], s["way"], F.lit("")), step)
            return bind(inner, lambda r: state(r["tags"], r["at"], r["way"], F.concat(s["done"], F.array(r["done"]))))

        def texts(s):
            still_open = F.when(F.size(s["at"]) > 0, ended_texts(s, F.size(s["at"]), last + 1)).otherwise("")
            return runs_after(F.concat(F.array_join(s["done"], ""), still_open), ";")

        return bind(F.aggregate(chunks, state(no_texts, no_numbers, no_numbers, no_texts), over), texts)

    tokens = F.transform(parts, token) if inert is None else without_inert(parts)
    return F.sort_array(F.transform(bind(tokens, lambda t: folded(t, F.size(parts))), element))


def markup_of(parts: Column, e: Column) -> Column:
    """What stands inside an element, tags included."""
    return after_open(F.array_join(F.slice(parts, e["begin"], e["end"] - e["begin"]), ""))


def holds(ancestor: Column, e: Column) -> Column:
    """Does the first element's interval hold the second element?"""
    return (ancestor["begin"] < e["begin"]) & (e["begin"] < ancestor["end"])


def children(all_elements: Column, parent: Column, tag: str) -> Column:
    """Elements of a name whose parent is the given one, in page order: siblings, so the n-th is `nth-of-type(n)`."""
    return F.filter(all_elements, lambda e: (e["tag"] == tag) & (e["parent"] == parent["begin"]))
