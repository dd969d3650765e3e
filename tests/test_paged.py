"""Laws over many rows: the same rows whatever the block size."""

import random

import pytest
from pyspark.sql import functions as F

from lawloom.operators import paged
from lawloom.operators import segment as S
from tests.test_segment import random_lines, rows_of


RULES = {"page": S.PAGE_RULES, "paragraph": S.PARAGRAPH_RULES}


def paged_rows(pages, **options):
    got = {}
    for r in sorted(paged.segment_pages(pages, **options).collect(), key=lambda r: r.ord):
        got.setdefault(r.law_name, []).append((r.chapter, r.article_number, r.article_title, r.clause_number, r.text))
    return got


@pytest.mark.parametrize("case", ["page", "paragraph"])
@pytest.mark.parametrize("per_block", [1, 3])
def test_pages_give_the_rows_of_the_whole_text(spark, case, per_block):
    rng = random.Random(11)
    docs = {f"법{i}": random_lines(rng) + random_lines(rng) + random_lines(rng) for i in range(60)}
    rows = []
    for name, lines in docs.items():
        at, page = 0, 0
        while at < len(lines):
            n = rng.randint(0, 4)
            rows.append((name, page, "\n".join(lines[at : at + n]) if n else None))
            at, page = at + n, page + 1
    df = spark.createDataFrame(rows, "law_name string, page_no int, text string")
    got = paged_rows(df, rules=RULES[case], pages_per_block=per_block)
    whole = rows_of(spark, list(docs.values()), RULES[case])
    for i, name in enumerate(docs):
        assert got.get(name, []) == whole[i], (name, docs[name])


def test_guard_over_many_blocks_needs_no_jobs(spark):
    rng = random.Random(4)
    rows, entries = [], {}
    for law in range(6):
        last = None
        for page in range(300):
            numbers = [rng.randint(1, 60) for _ in range(rng.choice([0, 1, 2, 3]))]
            rows.append((f"l{law}", page, page // 2, [f"제{n}조" for n in numbers]))
            if page % 2 == 0:
                entries[f"l{law}", page // 2] = last
            for n in numbers:
                last = n if last is None or abs(n - last) <= 5 else last
    df = paged._packed(spark.createDataFrame(rows, "law_name string, page_no int, blk long, _lines array<string>"), "_lines")
    jobs = lambda: len(spark.sparkContext.statusTracker().getJobIdsForGroup("guard"))
    spark.sparkContext.setJobGroup("guard", "planning")
    plan = paged.guard_entries(df, S.PAGE_RULES)
    assert jobs() == 0
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    for r in plan.collect():
        assert r.entry == entries[r.law_name, r.blk]


def test_levels_of_the_guard(spark):
    assert [paged.levels_for(n) for n in (None, 0, 63, 64, 4095, 4096, 64**3 - 1, 64**3)] == [1, 1, 1, 2, 2, 3, 3, 4]
    n = 64**3  # one law of as many blocks: numbers that rise by 1 every 50 blocks, with jumps that are refused
    number = lambda b: F.when(b % 97 == 5, b % 7 * 1000 + 500).otherwise(F.floor(b / 50) + 1)
    df = spark.range(n).select(F.lit("l").alias("law_name"), F.col("id").alias("blk"), F.array(F.concat(F.lit("제"), number(F.col("id")), F.lit("조"))).alias("_lines"))
    entries = paged.guard_entries(df, S.PAGE_RULES, paged.levels_for(n - 1))
    assert entries.count() == n
    last, wanted = None, {}
    for b in range(n):
        own = b % 7 * 1000 + 500 if b % 97 == 5 else b // 50 + 1
        wanted[b] = last
        last = own if last is None or abs(own - last) <= 5 else last
    some = entries.where("blk % 1009 = 3 or blk > 262000 or blk < 300").collect()
    assert len(some) > 600 and all(r.entry == wanted[r.blk] for r in some)


def test_rows_without_a_law_name_are_kept(spark):
    rows = [(None, 0, "제1조(가)\n하나"), (None, 1, "둘"), ("갑", 0, "제1조(나)\n셋")]
    got = paged_rows(spark.createDataFrame(rows, "law_name string, page_no int, text string"), pages_per_block=1)
    assert got == {None: [(None, "제1조", "가", None, "하나 둘")], "갑": [(None, "제1조", "나", None, "셋")]}


def test_paragraph_rows_keep_inner_breaks(spark):
    df = spark.createDataFrame([("갑", 0, "제1조(목적)"), ("갑", 1, " 첫째\n둘째 "), ("갑", 2, "① 항")], "law_name string, page_no int, text string")
    rows = sorted(paged.segment_pages(df, rules=S.PARAGRAPH_RULES, whole_rows=True).collect(), key=lambda r: r.ord)
    assert [(r.clause_number, r.text) for r in rows] == [("①", "항"), (None, "첫째\n둘째")]
