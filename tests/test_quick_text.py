"""Steps of the case fields that are quick on long texts, against the plain ones."""

import random
import time

from pyspark.sql import functions as F

from lawloom import constants as C
from lawloom.functions import text as X
from lawloom.operators import fields


def test_other_characters_are_all_but_the_letters(spark):
    df = spark.range(0x10FFFF + 1).where("id > 0 and (id < 55296 or id > 57343)")
    char = F.decode(F.unhex(F.lpad(F.hex("id"), 8, "0")), "UTF-32")
    assert df.select(char.alias("c")).where(F.col("c").rlike("[^0-9A-Za-z가-힣ㄱ-ㅎㅏ-ㅣ]") != F.col("c").rlike(C.NOT_LETTER)).count() == 0


def seconds(df, column):
    best = []
    for _ in range(3):
        start = time.perf_counter()
        df.select(column).write.format("noop").mode("overwrite").save()
        best.append(time.perf_counter() - start)
    return min(best)


def test_letters_are_passed_over_quickly(spark):
    """With the class of letters negated this took over ten times as long."""
    df = spark.createDataFrame([("an of reoush hewh, " * 20000,)] * 64, "t string").repartition(8).cache()
    df.count()
    assert seconds(df, X.letters_spaced(F.col("t"))) < 6 * seconds(df, X.collapse(F.col("t"))) + 0.5


def test_entities_left_by_decoding(spark):
    rng = random.Random(3)
    words = ["&", ";", "lt", "gt", "quot", "#39", "nbsp", "amp", "&lt;", "&gt;", "&quot;", "&#39;", "&nbsp;", "&amp;", "x", "가", "&copy;", "\U0001F600", "LT"]
    texts = ["", "&", "&;", "&lt", "&amp;lt;", "&amp;amp;", *["".join(rng.choice(words) for _ in range(n)) for n in [2, 4, 9, 30] for _ in range(200)]]

    def plain(t):
        for entity, char in [("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&nbsp;", " "), ("&amp;", "&")]:
            t = t.replace(entity, char)
        return t

    df = spark.createDataFrame([(t,) for t in texts] + [(None,)], "t string").select("t", X.unescape(F.col("t")).alias("u"))
    for r in df.collect():
        assert r.u == (None if r.t is None else plain(r.t))


def test_titles_and_sections_of_mixed_blocks(spark):
    page = ("<p><strong>기대 효과</strong> : 하나</p><p>Ab-가 나</p><p>ab 가나 다</p><div><p>깊은 글</p></div><P>둘</P><div><p><strong>개요</strong></p>"
            "<p>셋</p></div><p>넷</p><p>ab, 가나</p>")
    df = spark.createDataFrame([(page, " AB 가나"), (page, None)], "h string, t string")
    rows = [r.s for r in df.select(fields.strong_sections(F.col("h"), F.col("t")).alias("s")).collect()]
    assert [tuple(s) for s in rows[0]] == [("기대 효과", "하나 ab 가나 다 둘"), ("개요", "셋")]
    assert [tuple(s) for s in rows[1]] == [("기대 효과", "하나 Ab-가 나 ab 가나 다 둘"), ("개요", "셋")]


def test_rules_of_a_page_that_needs_lines_or_whole_text(spark):
    pages = [("<p>개선 사항 : 빠름</p><p>글</p>",), ("<p><strong>내용</strong> 하나</p><table><tr><th>조건</th><td>둘</td></tr><tr><td>x</td></tr></table>",), ("",), (None,)]
    df = fields.with_fields(spark.createDataFrame(pages, "html string").withColumn("서비스명", F.lit("t")))
    got = [(r["서비스 내용"], r["src_서비스 내용"], r["부가조건"], r["src_부가조건"], r["개선결과"], r["src_개선결과"]) for r in df.collect()]
    assert got[0] == ("개선 사항 : 빠름 글", "fallback", "", "empty", "빠름", "label")
    assert got[1] == ("하나", "strong", "둘", "pairs", "", "empty")
    assert got[2] == got[3] == ("", "empty", "", "empty", "", "empty")
