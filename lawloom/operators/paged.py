"""Segmentation of laws whose text is spread over many rows: pages, or one paragraph per row.

A law may be a large part of the table, so no law is gathered in one place. Its rows are packed
into blocks of a fixed number of pages; each block is cut in its own row; small summary rows carry
chapter, article and clause from block to block; texts that run over a block edge are rejoined.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lawloom import constants as C
from lawloom.functions.arrays import exploded, split_before
from lawloom.functions.text import blank_to_null, lines_of, strip
from lawloom.operators import segment as S
from lawloom.sources.staging import stored


#: Blocks of pages without a number begin here.
NO_PAGE = 2**40


def _row_lines(text: Column, whole_rows: bool) -> Column:
    """Lines of one input row; a paragraph row is one line."""
    if not whole_rows:
        return lines_of(text)
    one_line = F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x0b\x0c\r\x1c-\x1e\x85]", " ")
    return F.filter(F.array(strip(one_line)), lambda l: l != "")


def _kept(lines: Column, law: Column, rules: S.Rules) -> Column:
    return F.filter(lines, lambda l: ~S.is_page_line(l, law)) if rules.drop_page_lines else lines


def _packed(rows: DataFrame, value: str) -> DataFrame:
    """(law_name, blk, value): the arrays of a block's rows, in page order, as one array."""
    packed = rows.groupBy("law_name", "blk").agg(F.array_sort(F.collect_list(F.struct("page_no", value))).alias("_p"))
    return packed.select("law_name", "blk", F.flatten(F.transform("_p", lambda p: p[value])).alias(value))


#: A block's effect on the guard, as a list to look a number up in: the first entry within the gap of the last accepted
#: number says what that number becomes; without one it stays. An entry repeating an earlier number is never the first.
EFFECT = "array<struct<n:bigint,exit:bigint>>"
BLOCK_BITS = 6


def _effect_on(effect: Column, last: Column, gap: int) -> Column:
    """The last accepted number after a block, from the one before it (NULL: none yet, so any heading is accepted)."""
    hit = F.get(F.filter(effect, lambda x: last.isNull() | (F.abs(x["n"] - last) <= gap)), F.lit(0))
    return F.coalesce(hit["exit"], last)


def block_effect(numbers: Column, gap: int) -> Column:
    """Effect of a block's heading numbers, worked out from its end: an accepted number goes on as any earlier one would."""
    none = F.array().cast(EFFECT)

    def step(later, n):
        own = F.struct(n.alias("n"), _effect_on(later, n, gap).alias("exit"))
        return F.concat(F.array(own).cast(EFFECT), F.filter(later, lambda x: x["n"] != n))

    return F.aggregate(F.reverse(F.filter(numbers, lambda n: n.isNotNull())), none, step)


def _after(first: Column, second: Column, gap: int) -> Column:
    """Effect of two neighbours: where the first changes the number the second goes on from there, else the second alone acts."""
    moved = F.transform(first, lambda x: F.struct(x["n"].alias("n"), _effect_on(second, x["exit"], gap).alias("exit")))
    more = F.filter(second, lambda y: ~F.exists(first, lambda x: x["n"] == y["n"]))
    return F.concat(moved, more).cast(EFFECT)


def _entered(parts: Column, entry: Column, at: str, gap: int) -> Column:
    """array<struct<at,entry>>: the last accepted number before each part of an ordered array<struct<at,effect>>."""
    start = F.struct(entry.cast("bigint").alias("last"), F.array().cast(f"array<struct<{at}:bigint,entry:bigint>>").alias("out"))

    def step(state, part):
        return F.struct(
            _effect_on(part["effect"], state["last"], gap).alias("last"),
            F.concat(state["out"], F.array(F.struct(part[at].alias(at), state["last"].alias("entry")))).alias("out"),
        )

    return F.aggregate(parts, start, step)["out"]


def _numbers(lines: Column, rules: S.Rules) -> Column:
    headings = F.filter(lines, lambda l: S.is_heading(l, rules) & ~S.is_chapter(l))
    return F.transform(headings, S.heading_number)


def levels_for(last_block: int | None) -> int:
    """Levels of 64 after which all blocks of a law are in one group."""
    return max(1, -(-(last_block or 0).bit_length() // BLOCK_BITS))


def _effects(blocks: DataFrame, numbers: Column, gap: int) -> DataFrame:
    """(law_name, blk, effect) of the blocks that have headings."""
    numbered = blocks.select("law_name", "blk", numbers.alias("numbers")).where(F.size("numbers") > 0)
    return numbered.select("law_name", "blk", block_effect(F.col("numbers"), gap).alias("effect"))


def guard_entries(blocks: DataFrame, rules: S.Rules, levels: int = 5) -> DataFrame:
    """(law_name, blk, entry): the last accepted heading number before every block that has headings. blocks: (law_name, blk, _lines).

    Each block is described by its effect on the guard. The effects of up to 64 neighbours are composed to one, those again, and so on for
    `levels` levels; then the entries are handed down level by level. Only heading numbers take part, an effect names each number at most
    once, and no row holds more than 64 effects as long as the levels reach (see levels_for).
    """
    effects = _effects(blocks, _numbers(F.col("_lines"), rules), rules.gap_limit)
    return _handed_on(effects.withColumn("pos", F.col("blk")), rules.gap_limit, levels)


def _handed_on(effects: DataFrame, gap: int, levels: int) -> DataFrame:
    """guard_entries of (law_name, pos, blk, effect); `pos` orders the blocks of a law, and the levels are as many as its numbers need."""
    part, held, groups = effects, F.struct("pos", "blk", "effect"), []
    for _ in range(levels):
        own = part.groupBy("law_name", F.shiftright("pos", BLOCK_BITS).alias("grp")).agg(F.array_sort(F.collect_list(held)).alias("parts"))
        groups.append(own)
        composed = F.aggregate("parts", F.array().cast(EFFECT), lambda acc, b: _after(acc, b["effect"], gap))
        part = own.select("law_name", F.col("grp").alias("pos"), F.col("grp").alias("blk"), composed.alias("effect"))
    laws = part.groupBy("law_name").agg(F.array_sort(F.collect_list(held)).alias("parts"))
    entries = laws.select("law_name", F.inline(_entered(F.col("parts"), F.lit(None), "blk", gap)))
    for own in reversed(groups):
        entered = own.join(entries.withColumnRenamed("blk", "grp"), ["law_name", "grp"])
        entries = entered.select("law_name", F.inline(_entered(F.col("parts"), F.col("entry"), "blk", gap)))
    return entries


def _stored_entries(blocks: DataFrame, rules: S.Rules) -> DataFrame:
    """guard_entries over blocks (law_name, blk, _outline) whose numbers may lie far apart: as many levels as the most blocks of a law need.

    The effects are worked out once and kept in files, numbered in their law's order.
    """
    place = F.row_number().over(Window.partitionBy("law_name").orderBy("blk")) - 1
    numbers = S.candidate_numbers(split_before(F.col("_outline"), S.CANDIDATE))
    effects = _effects(blocks, numbers, rules.gap_limit).withColumn("pos", place.cast("bigint"))
    effects, seen = stored(effects, "law-effects", last=F.max("pos"))
    last = seen.get("last") or 0
    return _handed_on(effects, rules.gap_limit, levels_for(last) if last >= 2**BLOCK_BITS else 0)


def _summaries(tagged: DataFrame) -> DataFrame:
    """What every block hands on, and what it receives from the blocks before it; `entry` is passed through."""

    def last_piece(mark):
        return F.element_at(split_before(F.col("_tagged"), mark), -1)

    has_article, has_chapter = F.contains("_tagged", F.lit(S.ARTICLE)), F.contains("_tagged", F.lit(S.CHAPTER))
    since_article = last_piece(S.ARTICLE)
    last_clause = F.element_at(split_before(since_article, S.CLAUSE), -1)
    has_clause = F.startswith(last_clause, F.lit(S.CLAUSE))
    bounds = split_before(F.col("_tagged"), S.ARTICLE, S.CHAPTER)
    bound = F.size(bounds) - 1
    leaf = F.size(split_before(F.element_at(bounds, -1), S.CLAUSE)) - 1
    ends = tagged.select(
        "law_name",
        "blk",
        F.when(has_chapter, S._header_field(last_piece(S.CHAPTER), 1)).alias("chapter"),
        F.when(
            has_article,
            F.struct(
                blank_to_null(S._header_field(since_article, 1)).alias("number"),
                blank_to_null(S._header_field(since_article, 2)).alias("title"),
            ),
        ).alias("article"),
        F.when(
            has_article | has_clause, F.struct(F.when(has_clause, S._header_field(last_clause, 1)).alias("mark"))
        ).alias("clause"),
        F.when(bound > 0, F.struct("blk", bound.alias("no"))).alias("bound"),
        F.when((bound > 0) | (leaf > 0), F.struct("blk", bound.alias("no"), leaf.alias("leaf"))).alias("leaf"),
        F.struct(bound.alias("no"), leaf.alias("leaf")).alias("end"),
        "entry",
    )
    whole = Window.partitionBy("law_name")
    before = whole.orderBy("blk").rowsBetween(Window.unboundedPreceding, -1)
    carried = {f"in_{c}": F.last(c, ignorenulls=True).over(before) for c in ["chapter", "article", "clause", "bound", "leaf"]}
    return ends.withColumns(carried | {"first_blk": F.min("blk").over(whole), "last_blk": F.max("blk").over(whole)}).select(
        "law_name", "blk", *carried, "first_blk", "last_blk", "end", "entry"
    )


def segment_pages(
    pages: DataFrame,
    law_name: str = "law_name",
    page: str = "page_no",
    text: str = "text",
    rules: S.Rules = S.PAGE_RULES,
    pages_per_block: int = 256,
    whole_rows: bool = False,
) -> DataFrame:
    """Law rows of (law_name, page_no, text); `page` is a whole number, unique within its law.

    `whole_rows` takes every input row as one line (paragraphs). `ord` is a struct that sorts the
    rows of a law into reading order. Pages are read and cut into marked lines once; blocks are kept in files, and an outline
    without texts beside them, from which headings and the state before each block are found. Blocks then meet their state, are cut once, and
    their rows are kept in files. Only texts at a block's edge are brought together. Rows without a law name are one law of their own. A page without a number is a block of
    its own after all others of its law, in the order of a hash of its text. A text that runs over
    many blocks is one output value and is therefore gathered in one row.
    """
    law = F.col(law_name)
    unplaced = F.lit(NO_PAGE) + F.pmod(F.xxhash64(F.col(text)), F.lit(2**20))
    rows = pages.select(
        law.alias("law_name"),
        F.col(page).alias("page_no"),
        F.coalesce(F.floor(F.col(page) / pages_per_block), unplaced).alias("blk"),
        _kept(_row_lines(F.col(text), whole_rows), law, rules).alias("_lines"),
    )
    packed = _packed(rows, "_lines").withColumn("law_name", F.coalesce(F.concat(F.lit("="), "law_name"), F.lit("")))
    marked = packed.select("law_name", "blk", S.marked_lines(F.col("_lines"), rules).alias("_marked"))
    joined = marked.select("law_name", "blk", S.joined_lines(F.col("_marked")).alias("_joined"), S.joined_outline(F.col("_marked")).alias("_outline"))
    blocks, _ = stored(joined, "law-blocks")
    outlines = blocks.select("law_name", "blk", "_outline")
    if rules.gap_limit is not None:
        outlines = outlines.join(_stored_entries(outlines, rules), ["law_name", "blk"], "left")
    else:
        outlines = outlines.withColumn("entry", F.lit(None).cast("bigint"))
    states, _ = stored(_summaries(S.with_resolved_text(outlines.withColumnRenamed("_outline", "_joined"), rules, F.col("entry"))), "block-states")
    placed = S.with_resolved_text(blocks.drop("_outline").join(states, ["law_name", "blk"]), rules, F.col("entry"))
    if not rules.keep_preamble:
        seen = F.col("in_article").isNotNull()
        placed = placed.withColumn("_tagged", S._drop_text_before_first_article(F.col("_tagged"), seen))
    fields = ["chapter", "article_number", "article_title", "clause_number"]
    cut, _ = stored(_cut(placed, fields), "law-rows")
    whole = cut.where("not at_edge").select("law_name", "ord", *fields, "text")
    parts = cut.where("at_edge").groupBy("law_name", "ord", *fields)
    rejoined = parts.agg(F.array_sort(F.collect_list(F.struct("blk", "text"))).alias("_t")).select(
        "law_name", "ord", *fields, F.array_join(F.transform("_t", lambda t: t.text), " ").alias("text")
    )
    named = F.when(F.col("law_name") != "", F.substring("law_name", 2, 2**31 - 1))
    return whole.unionByName(rejoined).withColumn("law_name", named)


def _cut(placed: DataFrame, fields: list[str]) -> DataFrame:
    """Rows of every block; `ord` is the place in the law of the text that a row belongs to.

    Only what goes on from an earlier block, and the last text that the block opens, can belong to a text of several blocks (`at_edge`).
    """
    state = {
        "chapter": F.col("in_chapter"),
        "article_number": F.col("in_article.number"),
        "article_title": F.col("in_article.title"),
        "mark": F.col("in_clause.mark"),
    }
    keep = ["law_name", "blk", "in_bound", "in_leaf", "first_blk", "last_blk", "end"]
    cut = exploded(S.with_row_array(placed, state), keep, "_rows", "_pos", "_row").select(*keep, "_row.*")
    zero, first = F.lit(0), F.col("first_blk").alias("blk")
    own_bound = F.struct("blk", F.col("bound").alias("no"))
    own_leaf = F.struct("blk", F.col("bound").alias("no"), "leaf")
    going_on = F.coalesce("in_bound", F.struct(first, zero.alias("no")))
    running = F.coalesce("in_leaf", F.struct(first, zero.alias("no"), zero.alias("leaf")))
    bound = F.when(F.col("bound") == 0, going_on).otherwise(own_bound)
    leaf = F.when((F.col("bound") == 0) & (F.col("leaf") == 0), running).otherwise(own_leaf)
    order = F.struct(bound.alias("bound"), F.col("clause_number").isNull().alias("is_head"), leaf.alias("leaf"))
    goes_on = (F.col("bound") == 0) & (F.col("leaf") == 0)
    ends = (F.col("bound") == F.col("end.no")) & (F.col("leaf") == F.col("end.leaf"))
    at_edge = (F.col("first_blk") != F.col("last_blk")) & (goes_on | ends)
    return cut.select("law_name", order.alias("ord"), *fields, "text", "blk", at_edge.alias("at_edge"))
