"""Segmentation: documents worked by hand, and what must hold for any text."""

import random
import re

import pytest

from lawloom.operators import segment as S

MARKS = "①②③④⑤"

# Documents worked by hand: lines, then (chapter, article, title, clause, text) under the page rules and under the paragraph rules.
WORKED = [
    (
        ["제1장 총칙", "앞선 글", "제1조(목적)", "이 법은", "① 첫째", "이어서", "② 둘째", "제2조", "본문"],
        [
            ("제1장 총칙", "제1조", "목적", "①", "첫째 이어서"), ("제1장 총칙", "제1조", "목적", "②", "둘째"),
            ("제1장 총칙", "제1조", "목적", None, "이 법은"), ("제1장 총칙", "제2조", None, None, "본문"),
        ],
        [
            ("제1장 총칙", None, None, None, "앞선 글"), ("제1장 총칙", "제1조", "목적", "①", "첫째 이어서"),
            ("제1장 총칙", "제1조", "목적", "②", "둘째"), ("제1장 총칙", "제1조", "목적", None, "이 법은"),
            ("제1장 총칙", "제2조", None, None, "본문"),
        ],
    ),
    (  # 제40조 is too far from 1 to be a heading of a page, so it is text; 제5조 is near enough; paragraphs know no such guard
        ["제1조(가)", "하나", "제40조(나)", "둘", "제5조(다)", "셋"],
        [("제1조", "가", None, "하나 제40조(나) 둘"), ("제5조", "다", None, "셋")],
        [("제1조", "가", None, "하나"), ("제40조", "나", None, "둘"), ("제5조", "다", None, "셋")],
    ),
    (["제1조(가)", "제2조(나)", "① ", "제2장 다음", "② 뒤"], [("제2장 다음", "제2조", "나", "②", "뒤")], [("제2장 다음", "제2조", "나", "②", "뒤")]),
    (["① 머리", "글"], [(None, None, None, "①", "머리")], [(None, None, None, "①", "머리 글")]),
]


def rows_of(spark, docs, rules):
    df = spark.createDataFrame([(i, f"법{i}", "\n".join(d)) for i, d in enumerate(docs)], "doc_id int, law_name string, text string")
    got = {i: [] for i in range(len(docs))}
    for r in S.segment(df, rules=rules, keys=("doc_id",)).orderBy("doc_id", "ord").collect():
        got[r.doc_id].append((r.chapter, r.article_number, r.article_title, r.clause_number, r.text))
    return got


def random_lines(rng, numbers=40):
    n, out = 0, []
    for _ in range(rng.randint(0, 40)):
        kind = rng.random()
        if kind < 0.1:
            out.append(f"제{rng.randint(1, 9)}장 총칙")
        elif kind < 0.35:
            n = rng.choice([n + 1, n + 2, rng.randint(1, numbers)])
            out.append(rng.choice([f"제{n}조(목적)", f"제{n}조", f"제 {n} 조", f"제{n}조 (범위)"]))
        elif kind < 0.6:
            out.append(rng.choice(MARKS) + rng.choice(["", " 항 본문", "붙은 본문"]))
        else:
            out.append(rng.choice(["본문", "그 밖의 글", "1. 호", "가. 목"]))
    return out


@pytest.mark.parametrize("n,rules", [(1, S.PAGE_RULES), (2, S.PARAGRAPH_RULES)])
def test_worked_documents(spark, n, rules):
    got = rows_of(spark, [w[0] for w in WORKED], rules)
    for i, worked in enumerate(WORKED):
        want = [r if len(r) == 5 else (None, *r) for r in worked[n]]
        assert sorted(got[i], key=str) == sorted(want, key=str), worked[0]


def test_texts_add_up_to_the_lines(spark):
    """Every kept word is in exactly one row, under paragraph rules, which leave nothing out but headings and marks."""
    rng = random.Random(7)
    docs = [random_lines(rng) for _ in range(200)]
    for i, rows in rows_of(spark, docs, S.PARAGRAPH_RULES).items():
        plain = [line for line in docs[i] if not re.match(r"제\s*\d+\s*[조장]", line)]
        words = sorted(w for line in plain for w in line.lstrip(MARKS).split())
        assert sorted(w for r in rows for w in (r[4] or "").split()) == words


def test_guard_keeps_near_numbers_only(spark):
    rng = random.Random(8)
    docs = [[f"제{rng.randint(1, 60)}조" if k % 2 == 0 else f"글{k}" for k in range(60)] for _ in range(40)]
    for rows in rows_of(spark, docs, S.PAGE_RULES).values():
        numbers = [int(re.search(r"\d+", r[1])[0]) for r in rows]
        assert all(abs(a - b) <= 5 for a, b in zip(numbers, numbers[1:]))


def test_page_lines_and_white_space(spark):
    text = "법제처\n갑법\n12\n　제1조(목적)　\r\n ① 갑법은 \n\n본문\x85제2조(정의)"
    df = spark.createDataFrame([("갑법", text)], "law_name string, text string")
    rows = [tuple(r)[2:] for r in S.segment(df).orderBy("ord").collect()]
    assert rows == [(None, "제1조", "목적", "①", "갑법은 본문")]


def test_options(spark):
    text = "제1조(목적) 이 법은\n제2조의3(정의)\n① 가"
    df = spark.createDataFrame([("갑", text)], "law_name string, text string")
    rows = [tuple(r)[2:] for r in S.segment(df, rules=S.Rules(inline_body=True, branch_articles=True)).orderBy("ord").collect()]
    assert rows == [(None, "제1조", "목적", None, "이 법은"), (None, "제2조의3", "정의", "①", "가")]


def test_no_exchange_and_no_python(spark):
    df = spark.createDataFrame([("갑", "제1조")], "law_name string, text string")
    plan = S.segment(df)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan


def test_rejects(spark):
    df = spark.createDataFrame([("갑", None), ("을", " \n"), ("병", "제1조")], "law_name string, text string")
    assert {(r.key, r.error) for r in S.rejects(df).collect()} == {("갑", "no text"), ("을", "blank text")}
