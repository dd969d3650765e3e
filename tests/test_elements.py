"""Element intervals against a plain stack, and the four selectors on nested and unclosed pages."""

import random
import re

from pyspark.sql import functions as F

from lawloom import constants as C
from lawloom.functions import elements as E
from lawloom.functions import text as X
from lawloom.operators import fields

NAMES = ["section", "form", "div", "table", "thead", "tbody", "tr", "td", "th", "ul", "li"]
PATH = ["div", "table", "tr", "td"]


def by_stack(page):
    """(begin, end, parent, tag, hit) of every element, by a loop over the tags."""
    tags = re.findall(rf"(?i)<(/?)({'|'.join(NAMES)})(?=[\s>/])", page)
    stack, done = [], []

    def reach(names, scope):
        places = [k for k in range(len(stack)) if stack[k][3] in scope]
        low = places[-1] + 1 if places else 0
        wanted = {}
        for k in range(low, len(stack)):
            if stack[k][3] in names:
                wanted[stack[k][3]] = k
        return min(wanted.values(), default=len(stack))

    for at, (slash, name) in enumerate(tags, 1):
        name = name.lower()
        if slash:
            scope = () if name == "table" else ("table",) if name in ("td", "th", "tr", "thead", "tbody") else ("td", "th", "table")
            if name == "table":
                keep = max((k for k, e in enumerate(stack) if e[3] == "table"), default=len(stack))
            else:
                keep = reach((name,), scope)
        elif name in E.IMPLIED:
            keep = reach(*E.IMPLIED[name])
        else:
            keep = len(stack)
        for e in stack[keep:]:
            e[1] = at
            done.append(e)
        del stack[keep:]
        if not slash:
            through = stack[-1][5] if stack else 0
            step = through < len(PATH) and PATH[through] == name
            stack.append([at, 0, stack[-1][0] if stack else 0, name, step and through == len(PATH) - 1, through + step])
    for e in stack:
        e[1] = len(tags) + 1
        done.append(e)
    return sorted(tuple(e[:5]) for e in done)


def random_page(rng, size):
    """Tags in any order: unclosed, crossed and stray ones among them."""
    return "".join(f"<{'/' * (rng.random() < 0.4)}{rng.choice(NAMES).upper() if rng.random() < 0.1 else rng.choice(NAMES)} >t{i}" for i in range(size))


def test_intervals_equal_a_plain_stack(spark):
    rng = random.Random(7)
    pages = ["", "no tags", "<td>", "</div>", "<div" + ">", *[random_page(rng, n) for n in [3, 8, 20, 60, 127, 128, 129, 300] for _ in range(12)]]
    df = spark.createDataFrame(list(enumerate(pages)) + [(-1, None)], "id int, page string")
    found = E.elements(E.tag_parts(F.col("page"), NAMES), NAMES, [PATH])
    fewer = E.elements(E.tag_parts(F.col("page"), NAMES), NAMES, [PATH], ["ul"])
    for r in df.select("id", "page", found.alias("e"), fewer.alias("fewer")).collect():
        assert r.fewer == [e for e in r.e if e.tag == "ul" or e.hit[0]]
        if r.id < 0:
            assert r.e == []
        else:
            assert [(e.begin, e.end, e.parent, e.tag, e.hit[0]) for e in r.e] == by_stack(r.page), r.page


def test_markup_and_children(spark):
    page = "<ul><li>a<ul><li>b</ul>c<li>d</ul>"
    names = ["ul", "li"]
    df = spark.createDataFrame([(page,)], "page string").select(E.tag_parts(F.col("page"), names).alias("p"))
    df = df.withColumn("e", E.elements(F.col("p"), names))
    row = df.select(
        F.transform("e", lambda e: E.markup_of(F.col("p"), e)).alias("inside"),
        F.transform(E.children(F.col("e"), F.get("e", F.lit(0)), "li"), lambda e: E.markup_of(F.col("p"), e)).alias("own"),
        F.transform("e", lambda e: E.holds(F.get("e", F.lit(1)), e)).alias("held"),
    ).first()
    assert row.inside[0] == "<li>a<ul><li>b</ul>c<li>d"
    assert row.own == ["a<ul><li>b</ul>c", "d"]
    assert row.held == [False, False, True, True, False]


def cell(spark, html):
    return spark.createDataFrame([(html,)], "h string").select(fields.content_cell(F.col("h")).alias("x")).first().x


def grid(*texts):
    return "<table><tbody><tr>" + "".join(f"<td>{t}</td>" for t in texts) + "</tr></tbody></table>"


def test_four_selectors(spark):
    body = "<html><body><section><form><div>{}</div></form></section><section></section><section>{}</section></body></html>"
    assert cell(spark, body.format(grid("first and longest"), f"<form><div>{grid('third')}</div></form>")) == "third"
    # The div stands beside the table, not around it: no selector with a form takes the third section's cell.
    assert cell(spark, body.format(grid("in a section"), f"<form><div></div>{grid('longer than the other one')}</form>")) == "in a section"
    # Three sections, none of them a third child of the body.
    assert cell(spark, "<body><section><section></section><section><form><div>" + grid("x") + "</div></form></section></section>" + "</body>") == "x"
    assert cell(spark, f"<section></section><form><div>{grid('form')}</div></form>{grid('any table at all')}") == "form"
    assert cell(spark, f"<form></form>{grid('a', 'bb', 'cc')}") == "bb"
    assert cell(spark, "<table><tr><td>no body of rows</td></tr></table>") is None
    assert cell(spark, f"<form><div>{grid(' ', '')}</div></form>{grid('falls through')}") == "falls through"


def test_unclosed_and_nested(spark):
    assert cell(spark, "<form><div><table><tbody><tr><td>a<tr><td>long enough<td>b</table></div><td>stray") == "long enough"
    assert cell(spark, "<table><tbody><tr><td>x</div></form>y</td><td>z</table>") == "x</div></form>y"
    outer = "a<table><tbody><tr><td>b<td>c</table>d"
    assert cell(spark, f"<table><tbody><tr><td>{outer}</td></tr></tbody></table>") == outer
    # The outer cell is on no path (no tbody), so the inner one is found.
    assert cell(spark, "<table><tr><td>layout " + grid("inner") + "</td></tr></table>") == "inner"


def test_labels_in_one_pass_equal_a_search_per_alias(spark):
    rng = random.Random(11)
    words = [a for names in C.FIELD_ALIASES.values() for a in names] + [":", "：", " : ", ":\n", "\n", " ", "값", "해당 없음", "첨부파일", "x y", "\u3000"]
    texts = ["", ":", "내용 :", "내용 : ", "조건 : 효과 : 셋 : 넷\n효과 : 다섯", *["".join(rng.choice(words) for _ in range(n)) for n in [2, 5, 12, 40] for _ in range(150)]]
    flat = spark.createDataFrame(list(enumerate(texts)) + [(-1, None)], "id int, t string")

    def searched(alias):
        value = X.collapse(F.regexp_extract("t", rf"{alias}{C.WS}*[:：]{C.WS}*(.+)", 1))
        return F.when(~X.is_noise(value), value)

    df = flat.withColumn("p", fields.label_parts(F.col("t")))
    for f in C.FIELDS:
        wanted = F.coalesce(*[searched(a) for a in C.FIELD_ALIASES[f]])
        rows = df.select("t", fields.labelled_text(F.col("p"), f).alias("got"), wanted.alias("wanted")).collect()
        assert [(r.t, r.got) for r in rows] == [(r.t, r.wanted) for r in rows], f
        assert any(r.got for r in rows)


def content_folds(spark, pages, inert):
    df = spark.createDataFrame([(i, p) for i, p in enumerate(pages)], "i int, page string")
    parts = E.tag_parts(F.col("page"), fields.CONTENT_ELEMENTS)
    found = E.elements(parts, fields.CONTENT_ELEMENTS, fields.CELL_PATHS, ["body", "section"], inert)
    return [[tuple(e) for e in r.e] for r in df.select("i", found.alias("e")).orderBy("i").collect()]


def test_tables_in_a_cell_change_no_element(spark):
    rng = random.Random(7)
    inner = "<table><tbody><tr><th>a</th><td>b</td></tr><tr></tr></tbody></table><TABLE><tr><td>c</td></tr></TABLE>"
    frames = ["<table><tbody><tr><td>{}</td></tr></tbody></table>", "<table><tbody><tr><th>x</th></tr><tr><td>y</td><td>{}<td>z</table>",
              "<form><div>{}</div></form>", "</table><tbody><tr><td>{}", "<section>{}</section>", "<table><tr><td>{}</td></tr></table>"]
    pages = []
    for _ in range(120):
        page = "".join(rng.choice([inner, "<td>", "</tr>", "</table>", "x"]) for _ in range(rng.randint(1, 3)))
        for _ in range(rng.randint(0, 4)):
            page = rng.choice(frames).format(page + rng.choice(["", inner]))
        pages.append(page)
    assert content_folds(spark, pages, fields.TABLES_IN_CELL) == content_folds(spark, pages, None)


def test_fold_passes_over_tables_in_a_cell(spark):
    page = "<table><tbody><tr><td>" + "<table><tbody>" + "<tr><td>x</td></tr>" * 5000 + "</tbody></table></td></tr></tbody></table>"
    tags = "".join(f"{t} {i};" for i, t in enumerate(re.findall(r"<(/?\w+)", page), 1))
    left = spark.createDataFrame([(tags,)], "t string").select(F.regexp_replace("t", fields.TABLES_IN_CELL, "$1").alias("t")).first().t
    assert left.count(";") == 8


def test_quick_patterns_take_the_same_characters(spark):
    df = spark.range(0x10FFFF + 1).where("id > 0 and (id < 55296 or id > 57343)")
    char = F.decode(F.unhex(F.lpad(F.hex("id"), 8, "0")), "UTF-32")
    quick = {C.WS: C.WS_QUICK, "[0-9A-Za-z가-힣ㄱ-ㅎㅏ-ㅣ]": f"[{C.LETTERS}]"}
    for plain, other in quick.items():
        assert df.select(char.alias("c")).where(F.col("c").rlike(plain) != F.col("c").rlike(other)).count() == 0
    long = "[0-9A-Za-z가-힣ㄱ-ㅎㅏ-ㅣ]"
    rows = spark.range(3000).select(F.concat(*[F.element_at(F.array(*[F.lit(x) for x in [" ", "a", "\t", "가", "　", "-", "B", "\U0001F600"]]),
        (F.xxhash64("id", F.lit(k)) % 4 + 4).cast("int") + 1) for k in range(9)]).alias("t"))
    run = rf"(?:{C.WS.replace(chr(92) + 'x20', chr(92) + 'x1f')}{C.WS}*| {C.WS}+)"
    spaced = f"[^{long[1:-1]} ][^{long[1:-1]}]*| [^{long[1:-1]}]+"
    pairs = [(X.collapse(F.col("t")), F.trim(F.regexp_replace("t", run, " "))), (X.letters_spaced(F.col("t")), F.trim(F.regexp_replace("t", spaced, " "))),
             (X.compare_key(F.col("t")), F.lower(F.replace(F.regexp_replace("t", spaced, " "), F.lit(" "), F.lit(""))))]
    for new, old in pairs:
        assert rows.where(~new.eqNullSafe(old)).count() == 0
