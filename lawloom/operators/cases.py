"""Free-zone cases and the special-law list."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lawloom import constants as C
from lawloom.functions.arrays import bind, running_sum
from lawloom.functions.markup import FIELD, MARK_A, MARK_B, cut_at, flow_text, node_lines, prepare, runs_after, steps
from lawloom.functions.text import (
    collapse, drop_leading_index, drop_prefix, first_sentence, letters_only, round_title, strip, trial_title,
)
from lawloom.operators.carry import fill_forward

_WS = C.WS


def subtitle(html: Column) -> Column:
    """First strong text; else the first bracketed text; else the first sentence before a label."""
    strong = r"(?is)<strong\b[^>]*>(.*?)</strong\s*>"
    bracket = r"\[([^\]]+)\]"
    label = rf"[(\[]?{_WS}*(?:현황|허용|조건부{_WS}*허용){_WS}*[)\]]"

    def of_text(flat):
        before = F.get(F.split(flat, label, 2), F.lit(0))
        return F.when(flat.rlike(bracket), collapse(F.regexp_extract(flat, bracket, 1))).otherwise(first_sentence(before))

    def of_page(page):
        return F.when(page.rlike(strong), flow_text(F.regexp_extract(page, strong, 1))).otherwise(bind(flow_text(page), of_text))

    return bind(prepare(html), of_page)


def _labelled(part: Column) -> Column:
    """struct<state,text,filled>: state 'stat', 'allow' or NULL of one block, its label removed from the text."""
    bold = r"(?is)<(b|strong)\b[^>]*>(.*?)</\1\s*>"

    def state_of(label, word, pointed):
        return (
            F.when(label != "", F.when(F.contains(label, F.lit("허용")), "allow").otherwise("stat"))
            .when(word.isNotNull(), F.when(F.contains(word, F.lit("현황")), "stat").otherwise("allow"))
            .when(pointed, "allow")
        )

    def of_text(text):
        words = F.filter(F.transform(F.regexp_extract_all(part, F.lit(bold), F.lit(2)), flow_text), lambda w: w.rlike("현황|허용"))
        signs = F.struct(
            F.regexp_extract(text, "(?i)" + C.STATUS_LABEL, 1).alias("label"),
            F.get(words, F.lit(0)).alias("word"),
            (F.startswith(text, F.lit("☞")) & F.contains(text, F.lit("허용"))).alias("pointed"),
        )
        return bind(
            signs,
            lambda s: F.struct(
                state_of(s.label, s.word, s.pointed).alias("state"),
                F.when(s.label != "", drop_prefix(text, C.STATUS_LABEL))
                .when(s.word.isNull() & s.pointed, strip(F.ltrim(text, F.lit("☞"))))
                .otherwise(text)
                .alias("text"),
                (text != "").alias("filled"),
            ),
        )

    return bind(flow_text(part), of_text)


def _labelled_runs(html: Column) -> Column:
    """array<struct<state,text>>: runs of blocks under the label that opened them.

    A part begins at every opening or closing p/div tag, so text is never taken twice and
    text after a nested block stays with its parent. Text before any label is dropped.
    """

    def inside_blocks(parts):
        placed = F.arrays_zip(parts.alias("part"), running_sum(steps(parts, "p|div")).alias("depth"))
        kept = F.filter(placed, lambda z: (z.depth > 0) | z.part.rlike(r"(?i)^<(?:p|div)\b"))
        return F.transform(kept, lambda z: _labelled(z.part))

    blocks = bind(cut_at(prepare(html), r"(?i)</?(?:p|div)\b"), inside_blocks)
    tagged = F.array_join(
        F.transform(
            F.filter(blocks, lambda b: b.filled),
            lambda b: F.concat(F.coalesce(F.concat(F.lit(MARK_B), b.state, F.lit(FIELD)), F.lit(MARK_A)), b.text),
        ),
        "",
    )
    return F.transform(
        runs_after(tagged, MARK_B),
        lambda r: F.struct(
            F.substring_index(r, FIELD, 1).alias("state"),
            F.replace(F.substring_index(r, FIELD, -1), F.lit(MARK_A), F.lit(" ")).alias("text"),
        ),
    )


def with_status_and_allowance(df: DataFrame, html: str = "html") -> DataFrame:
    """Adds 현황 and 허용 to rows that hold one case block each."""
    runs = df.withColumn("_runs", _labelled_runs(F.col(html)))

    def joined(state):
        return collapse(F.array_join(F.transform(F.filter("_runs", lambda r: r.state == state), lambda r: r.text), " "))

    split = runs.withColumns({"_stat": joined("stat"), "_allow": joined("allow")})

    def flat_sections(flat):
        for pattern, name in [
            (rf"[(\[]{_WS}*현황{_WS}*[)\]]", "현황"),
            (rf"[(\[]{_WS}*(?:조건부{_WS}*)?허용{_WS}*[)\]]", "허용"),
            (r"(?<!\|)\b현황\b(?!\|)", "현황"),
            (rf"(?<!\|)\b(?:조건부{_WS}*)?허용\b(?!\|)", "허용"),
        ]:
            flat = F.regexp_replace(flat, pattern, f" ||{name}|| ")
        flat = F.regexp_replace(flat, r"☞+([^|]*허용[^|]*)", " ||허용|| $1 ")
        stat = r"(?s)\|\|현황\|\|(.*?)(?=\|\|허용\|\||\z)"
        return bind(
            flat,
            lambda t: F.struct(
                collapse(F.regexp_extract(t, stat, 1)).alias("stat"),
                collapse(F.regexp_extract(t, r"(?s)\|\|허용\|\|(.*)\z", 1)).alias("allow"),
            ),
        )

    none = (F.col("_stat") == "") & (F.col("_allow") == "")
    split = split.withColumn("_flat", F.when(none, flat_sections(flow_text(prepare(F.col(html))))))
    stat = F.coalesce(F.col("_flat.stat"), F.col("_stat"))
    allow = F.coalesce(F.col("_flat.allow"), F.col("_allow"))
    return split.withColumns({"현황": drop_prefix(stat, C.STATUS_PREFIX), "허용": drop_prefix(allow, C.ALLOW_PREFIX)}).drop(
        "_runs", "_stat", "_allow", "_flat"
    )


def case_rows(
    blocks: DataFrame, keys: tuple[str, ...] = (), page: str = "page_id", pos: str = "pos"
) -> DataFrame:
    """(대제목, 중제목, 소제목, 현황, 허용) of visible blocks.

    Input rows: page_id, pos, title (tab title), tag, html, is_visible. A visible h4 names the blocks
    after it, up to the next visible h4; blocks under an empty heading are left out. Blocks are read
    before headings are carried, so what is shuffled is the result and not the page.
    """
    shown = blocks.where("is_visible")
    is_heading = F.lower("tag") == "h4"
    body = F.when(~is_heading, F.col("html"))  # headings hold no status
    read = with_status_and_allowance(shown.withColumn("_body", body), "_body").select(
        *keys,
        page,
        pos,
        round_title(F.col("title")).alias("대제목"),
        F.when(is_heading, trial_title(flow_text(F.col("html")))).alias("_mid"),
        F.when(~is_heading, subtitle(F.col("html"))).alias("소제목"),
        "현황",
        "허용",
    )
    named = fill_forward(read, [page], pos, {"중제목": "_mid"})
    return named.where(F.col("소제목").isNotNull() & (F.col("중제목") != "")).select(
        *keys, page, pos, "대제목", "중제목", "소제목", "현황", "허용"
    )


def _heading(words: list[str]) -> str:
    joined = rf"{_WS}*".join(words)
    return rf"(?:^|\n){_WS}*[{C.HEADING_BULLETS}]?{_WS}*{joined}{_WS}*[:：-]?{_WS}*"


RELATED_HEADING = _heading(["관계", "법령"])
SPECIAL_HEADING = _heading(["규제", "특례", "사항"])


def with_two_sections(df: DataFrame, pre: str = "pre") -> DataFrame:
    """Adds 관계법령_raw and 규제특례사항_raw, by headings in either order, else by strong marks."""

    def found(pattern):
        return F.regexp_extract("_text", rf"(?dms)\A(.*?){pattern}", 0)

    def ahead(pattern):
        return F.regexp_extract("_text", rf"(?dms)\A(.*?){pattern}", 1)

    raw = F.coalesce(F.col(pre), F.lit(""))
    inner = F.when(raw.rlike(r"(?i)<pre\b"), F.regexp_extract(raw, r"(?is)<pre\b[^>]*>(.*?)(?:</pre\s*>|\z)", 1)).otherwise(raw)
    df = df.withColumn("_inner", inner).withColumn("_text", F.regexp_replace(node_lines(F.col("_inner")), "\n{3,}", "\n\n"))
    df = df.withColumns(
        {
            "_has_rel": F.col("_text").rlike(f"(?dm){RELATED_HEADING}"),
            "_has_spec": F.col("_text").rlike(f"(?dm){SPECIAL_HEADING}"),
            "_rel_end": F.length(found(RELATED_HEADING)),
            "_spec_end": F.length(found(SPECIAL_HEADING)),
            "_rel_start": F.length(ahead(RELATED_HEADING)),
            "_spec_start": F.length(ahead(SPECIAL_HEADING)),
        }
    )

    def section(has, start, end, other_has, other_start):
        ends_early = F.col(other_has) & (F.col(start) < F.col(other_start))
        size = F.greatest(F.col(other_start) - F.col(end), F.lit(0))
        cut = F.when(ends_early, F.substr("_text", F.col(end) + 1, size)).otherwise(F.substr("_text", F.col(end) + 1))
        return F.when(F.col(has), collapse(cut)).otherwise("")

    df = df.withColumns(
        {
            "_rel": section("_has_rel", "_rel_start", "_rel_end", "_has_spec", "_spec_start"),
            "_spec": section("_has_spec", "_spec_start", "_spec_end", "_has_rel", "_rel_start"),
            "_strong": F.split("_inner", r"(?is)<strong\b[^>]*>.*?</strong\s*>", 3),
        }
    )
    no_heading = (F.col("_rel") == "") & (F.col("_spec") == "")
    first = F.when(F.size("_strong") > 1, F.get("_strong", F.lit(1))).otherwise(F.col("_inner"))
    second = F.coalesce(F.get("_strong", F.lit(2)), F.lit(""))
    return df.withColumns(
        {
            "관계법령_raw": F.when(no_heading, flow_text(first)).otherwise(F.col("_rel")),
            "규제특례사항_raw": F.when(no_heading, flow_text(second)).otherwise(F.col("_spec")),
        }
    ).drop(
        "_inner", "_text", "_has_rel", "_has_spec", "_rel_end", "_spec_end", "_rel_start", "_spec_start", "_rel", "_spec", "_strong"
    )


def special_law_list(df: DataFrame, title: str = "title", pre: str = "pre", keys: tuple[str, ...] = ()) -> DataFrame:
    """Three cleaned columns; the leading index leaves the title before letters are kept."""
    return with_two_sections(df, pre).select(
        *keys,
        letters_only(drop_leading_index(F.col(title))).alias("특례법령"),
        letters_only(F.col("관계법령_raw")).alias("관계법령"),
        letters_only(F.col("규제특례사항_raw")).alias("규제특례사항"),
    )
