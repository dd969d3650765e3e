"""Table choice with few passes over the text, against the plain steps."""

import random

from pyspark.sql import functions as F

from checks import inputs as I
from lawloom import constants as C
from lawloom.functions import markup, text as X
from lawloom.operators import tables
from tests.test_large_inputs import documents

PARTS = [
    "<table>", "</table>", "<table class=x>", "</TABLE >", "<tbody>", "<TBODY id='a'>", "</tbody>", "<tr>", "<TR class=y>", "</tr>", "<tr", "<tbody", "<tbody ",
    ">", "<tr/", "<trx>", "<tbodyx>", "<thead>", "</thead>", "<th>서비스</th>", "<td>등록일 No</td>", "<td>", "</td>", "글", " ", "\n", "No", "</tbody", "<td>- 보기</td>",
]


def pages(n=3000):
    rng = random.Random(7)
    return ["".join(rng.choice(PARTS) for _ in range(rng.randint(0, 40))) for _ in range(n)]


def test_rows_are_found_and_counted_as_by_cutting(spark):
    df = spark.createDataFrame([(f"<table>{p}",) for p in pages()], "t string").withColumn("n", F.size(tables._body_rows(F.col("t"))))
    cut = F.coalesce(F.get(tables._rows(F.col("t")), F.lit(0)), F.lit(""))
    rows = df.select("t", "n", cut.alias("cut"), tables._first_row(F.col("t")).alias("first"), *[tables._has_body_rows(F.col("t"), k).alias(f"has{k}") for k in (1, 3, 5)])
    for r in rows.collect():
        assert r.first == r.cut and [r.has1, r.has3, r.has5] == [(r.n or 0) >= k for k in (1, 3, 5)], r.t


def test_a_table_is_read_once_for_all_words(spark):
    """Each word of the score used to read the header, or the whole table, anew."""
    df = spark.createDataFrame([("",)], "html string")
    for choice, mark in [(tables.list_table(F.col("html")), "<thead("), (tables.section_table(F.col("html"), None), "br|p|div|tr|li")]:
        assert df.select(choice.alias("x"))._jdf.queryExecution().optimizedPlan().toString().count(mark) == 1


def test_tables_of_pages(spark):
    page = (
        "<table><tr><td>공지 서비스</td></tr></table><table><thead><tr><th>No</th><th>기업</th></tr></thead><tbody><tr><td>가</td></tr></tbody></table>"
        "<table><tbody><tr><th>규제</th><td>지정 내용 및 부가 조건, 서비스에 관한 긴 글이 여기에 있습니다</td></tr></tbody></table>"
    )
    df = spark.createDataFrame([(page,), ("<p>없음</p>",), (None,)], "html string")
    text = lambda t: markup.flow_text(markup.inside(t, "table"))
    prepared = markup.prepare(F.col("html"))
    got = df.select(text(tables.section_table(prepared, None)), text(tables.list_table(prepared))).collect()
    assert [tuple(r) for r in got] == [("규제 지정 내용 및 부가 조건, 서비스에 관한 긴 글이 여기에 있습니다", "No 기업 가"), ("", ""), ("", "")]


def test_financial_pages_are_worked_on_by_many_tasks(spark, tmp_path):
    made = I.financial_pages(spark, documents(spark, tmp_path))
    assert made.rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism and made.count() == 40


def test_quick_text_steps_give_the_plain_results(spark):
    rng = random.Random(8)
    words = ["\r\n", "\r", "\n", "\n\n\n", "\x0b", "\x0c", "\x1c", "\x1e", "\x1f", "\x85", " ", " ", " ", "  ", "\t", " ", "　", "가", "- ", "(1) ", "①",
             "제 1 조", "<LAW x>", "</law>", "< LAW_1 >", "<", ">", "a", "&lt;", "1. "]
    texts = ["".join(rng.choice(words) for _ in range(rng.randint(0, 25))) for _ in range(3000)]
    t = F.col("t")

    def plain_lines(c):
        return F.split(F.regexp_replace(c, "\r\n|[\n\x0b\f\r\x1c-\x1e\x85  ]", "\n"), "\n")

    def plain_tags(c):
        return F.regexp_replace(F.regexp_replace(c, "(?i)</?LAW[^>]*>", ""), rf"(?i)<{C.WS}*LAW[_A-Za-z0-9\-]*{C.WS}*>", "")

    def plain_law_lines(c):
        c = F.replace(F.replace(F.coalesce(c, F.lit("")), F.lit("\r"), F.lit("\n")), F.lit(" "), F.lit(" "))
        c = F.array_join(F.transform(plain_lines(F.regexp_replace(X.strip(c), "\n{3,}", "\n\n")), X.strip), "\n")
        c = plain_tags(F.regexp_replace(c, "[ \t]{2,}", " "))
        line = lambda l: F.when(l.rlike(rf"^{C.WS}*제{C.WS}*\p{{Nd}}+{C.WS}*조"), X.strip(l)).otherwise(X.strip(F.regexp_replace(l, rf"^{C.LEADING_BULLETS}++", "")))
        return X.strip(F.array_join(F.transform(plain_lines(c), line), "\n"))

    pairs = {
        "lines": (X._split_lines(t), plain_lines(t)), "tags": (X.drop_law_tags(t), plain_tags(t)), "kept": (X.keep_law_lines(t), plain_law_lines(t)),
        "blanks": (F.regexp_replace(t, markup.BLANKS, " "), F.regexp_replace(t, r"\s+", " ")),
    }
    df = spark.createDataFrame([(x,) for x in texts] + [(None,)], "t string")
    for name, (quick, plain) in pairs.items():
        assert df.where(~quick.eqNullSafe(plain)).limit(3).collect() == [], name
