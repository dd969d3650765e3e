"""Known examples of single rules."""

import pytest
from pyspark.sql import functions as F

from lawloom.functions import clauses as K
from lawloom.functions import text as X
from lawloom.operators import cases, fields, listing, manifest, normalize
from lawloom.operators import segment as S

CASES = [
    (X.file_name, '테스트<>:"/\\|?* ', "테스트"),
    (X.file_name, ' ?* ', "법령"),
    (X.short_document_name, "법(일부) 시행 령" + "가" * 60, ("법_시행_령" + "가" * 60)[:50]),
    (X.form_encoded, "가 a*~/", "%EA%B0%80+a%2A~%2F"),
    (X.path_encoded, "가 a*~/", "%EA%B0%80%20a%2A~/"),
    (X.drop_leading_index, "1 제목", "제목"),
    (X.drop_leading_index, "09. 제목", "제목"),
    (X.drop_leading_index, "194~195. 제목", "제목"),
    (X.drop_leading_index, "12-13 제목", "제목"),
    (X.drop_leading_index, "제135조", "제135조"),
    (X.round_title, "10차 - X", "X"),
    (X.round_title, "10차X", "X"),
    (X.round_title, "①차 - X", "X"),
    (X.trial_title, "실증특례", "실증특례"),
    (X.trial_title, "② (실증 특례) - 드론", "드론"),
    (X.null_word_to_blank, "해당 없음.", ""),
    (X.null_word_to_blank, " - ", ""),
    (X.null_word_to_blank, "없음 아님", "없음 아님"),
    (X.iso_date, "20240131", "2024-01-31"),
    (X.iso_date, "2024.1", "2024.1"),
    (X.collapse, " 가　\t나\x1c ", "가 나"),
    (X.collapse, None, ""),
    (X.letters_spaced, "가-나ㄱ(a)1", "가 나ㄱ a 1"),
    (X.letters_only, "가-나ㄱ(a)1", "가나a1"),
    (X.compare_key, "서비스 (Name)", "서비스name"),
    (X.clean_cell, "﻿●가\n---\n\n\n나<LAW_1> ", "가\n\n나"),
    (X.clean_cell, None, None),
    (X.keep_law_lines, "- 1) 가\r\n제 3 조 - 나\n1.5%", "가\n\n제 3 조 - 나\n5%"),
    (X.keep_law_lines, "-" * 30000 + " 끝", "끝"),
    (lambda c: X.keep_law_lines(c, keep_decimals=True), "1.5%", "1.5%"),
    (X.unescape, "&amp;lt; &lt;b&gt;&nbsp;&quot;", '&lt; <b> "'),
    (X.strip_separators, " :– 가 ·", "가"),
    (K.clause_label, "①", "1항"),
    (K.clause_label, "⑳", "20항"),
    (K.clause_label, None, ""),
    (K.clause_label, "전문", "전문"),
    (fields.header_field, "신청 내용", "서비스 내용"),
    (fields.header_field, "규제 특례 사항", "특례 내용"),
    (fields.header_field, "연락처", None),
    (lambda c: S.heading_parts(c)[0], "제35조(과징금 처분 등) ① 국토교통부장관...", "제35조"),
    (lambda c: S.heading_parts(c)[1], "제35조(과징금 처분 등) ① 국토교통부장관...", "과징금 처분 등"),
    (lambda c: S.heading_parts(c)[2], "제35조(과징금 처분 등) ① 국토교통부장관...", "① 국토교통부장관..."),
    (lambda c: S.heading_parts(c, S.PARAGRAPH_RULES)[1], "제10조 수용 및 사용", "수용 및 사용"),
]


def test_golden(spark):
    df = spark.range(1).select(*[f(F.lit(v).cast("string")).alias(f"c{i}") for i, (f, v, _) in enumerate(CASES)])
    for got, (_, value, expected) in zip(df.first(), CASES):
        assert got == expected, value


def test_remove_once_and_clauses(spark):
    row = spark.sql("select 'a.b a.b' t, 'a.b' p, '머리 ① 가 ② ③ 나' c, '① 가 생략' o").select(
        X.remove_once(F.col("t"), F.col("p")), K.clause_array(F.col("c")), K.clause_array(F.col("o")), K.clause_array(F.col("c"), keep_lead=True)
    ).first()
    assert row[0] == " a.b"
    assert [(x.mark, x.text) for x in row[1]] == [("①", "가"), ("③", "나")]
    assert [(x.mark, x.text) for x in row[2]] == [(None, "① 가 생략")]
    assert [(x.mark, x.text) for x in row[3]][0] == (None, "머리")


def test_law_names(spark):
    df = spark.createDataFrame([("법령A",), (" ",), (None,), ("법령B ",)], "name string")
    assert [r.law_name for r in manifest.law_names(df, "name").collect()] == ["법령A", "법령B"]
    with pytest.raises(ValueError):
        manifest.law_names(df, "없는 열")
    with pytest.raises(ValueError):
        manifest.law_names(df.where("name = ' '"), "name")
    with pytest.raises(ValueError):
        manifest.check_format("hwp")


def test_nested_table_stays_in_its_cell(spark):
    html = "<table><tbody><tr><td>a<table><tr><td>b</td></tr></table>c</td><td>d</td></tr></tbody></table>"
    row = spark.createDataFrame([(html,)], "h string").select(fields.content_cell(F.col("h")).alias("x")).first()
    assert row.x == "a<table><tr><td>b</td></tr></table>c"


def test_fallback_chain_and_missing_page(spark):
    td = "<table><tbody><tr><td><p><strong>기대 효과</strong> : 좋음</p><p>작성일 2024</p><p>규제 : 있음</p>" \
         "<dl><dt>조건</dt><dd>둘</dd></dl></td></tr></tbody></table>"
    df = spark.createDataFrame([(td, "이름"), (None, "이름")], "html string, `서비스명` string")
    rows = fields.with_filled_list(fields.with_fields(df)).collect()
    full = next(r for r in rows if r["html"])
    none = next(r for r in rows if not r["html"])
    assert (full["기대효과"], full["src_기대효과"]) == ("좋음 규제 : 있음", "strong")
    assert (full["부가조건"], full["src_부가조건"]) == ("둘", "pairs")
    assert (full["규제"], full["src_규제"]) == ("있음", "label")
    assert full["extracted_columns"] == "부가조건|규제|기대효과"
    assert none["src_규제"] == "empty" and none["서비스 내용"] == ""


def test_date_range_keeps_unparsed(spark):
    df = spark.createDataFrame([("2024-01-01",), ("2024-02-01",), ("미정",)], "d string")
    assert [r.d for r in df.where(listing.in_date_range(F.col("d"), "2024-01-15", "2024-02-01")).collect()] == ["2024-02-01", "미정"]


def test_status_of_nested_blocks(spark):
    html = "<div>(현황) 가<p>나</p>다</div>라<p>조건부 허용: 마</p>"
    row = cases.with_status_and_allowance(spark.createDataFrame([(html,)], "html string")).first()
    assert (row["현황"], row["허용"]) == ("가 나 다", "마")


def test_strict_rename_needs_all_columns(spark):
    with pytest.raises(ValueError):
        normalize.normalize_ict(spark.createDataFrame([("1",)], "`번호` string"))
