"""Laws over many blocks move their texts few times: one join, and only texts at a block's edge are brought together."""

import random
import time

from pyspark.sql import functions as F

from checks import inputs as I
from lawloom.functions.arrays import exploded
from lawloom.operators import paged
from lawloom.operators import segment as S
from lawloom.sources import staging
from tests.test_paged import paged_rows
from tests.test_segment import random_lines


def exchanges(spark, df):
    kept = {k: spark.conf.get(k, None) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    plan = df.select("*")._jdf.queryExecution().executedPlan().toString()
    for k, v in kept.items():
        spark.conf.set(k, v) if v else spark.conf.unset(k)
    return plan.count("Exchange hashpartitioning")


def law(lines, name="법", page=3):
    return [(name, i // page, "\n".join(lines[i : i + page])) for i in range(0, len(lines), page)]


def test_only_texts_at_an_edge_are_brought_together(spark, tmp_path, monkeypatch):
    lines = [x for n in range(1, 201) for x in (f"제{n}조(가{n})", "① 하나", "② 둘", "글")]
    monkeypatch.setattr(staging, "shared_folder", lambda spark: str(tmp_path))
    rows = paged.segment_pages(spark.createDataFrame(law(lines), "law_name string, page_no int, text string"), pages_per_block=8)
    assert exchanges(spark, rows) == 1 and rows.count() == 400
    cut = spark.read.parquet(f"{tmp_path}/law-rows-*")
    assert cut.select("blk").distinct().count() == 34 and cut.where("at_edge").count() <= 2 * 34 and cut.count() >= 400


def test_a_last_page_without_number_is_the_last(spark):
    rng = random.Random(12)
    pages = [r for i in range(40) for r in law([x for _ in range(rng.randint(1, 6)) for x in random_lines(rng)], f"법{i}", rng.randint(1, 4))]
    last = {}
    for name, page, _ in pages:
        last[name] = page
    bare = [(name, None if page == last[name] and page else page, text) for name, page, text in pages]
    frames = [spark.createDataFrame(p, "law_name string, page_no int, text string") for p in (pages, bare)]
    for rules in (S.PAGE_RULES, S.PARAGRAPH_RULES):
        want = paged_rows(frames[0], rules=rules, pages_per_block=100)
        assert want and all(paged_rows(frames[1], rules=rules, pages_per_block=n) == want for n in (1, 3))


def test_levels_are_as_many_as_the_blocks_of_a_law(spark):
    """Blocks without a number lie far beyond the others; the levels that reach them used to be seven."""
    rows = [("갑", b, f"제{n}조") for b, n in [(0, 1), (1, 9), (paged.NO_PAGE + 7, 3), (paged.NO_PAGE + 2**20 - 1, 8)]]
    blocks = spark.createDataFrame(rows, "law_name string, blk long, line string")
    blocks = blocks.select("law_name", "blk", S.joined_outline(S.marked_lines(F.array("line"), S.PAGE_RULES)).alias("_outline"))
    entries = paged._stored_entries(blocks, S.PAGE_RULES)
    assert {r.blk - paged.NO_PAGE if r.blk > 9 else r.blk: r.entry for r in entries.collect()} == {0: None, 1: 1, 7: 1, 2**20 - 1: 3}
    assert exchanges(spark, entries) == 1


def test_outline_has_no_texts(spark):
    lines = ["제1장 총칙", "제1조(목적)", "글 하나", "① 가 나", "제2조 다"]
    marked = S.marked_lines(F.array(*[F.lit(x) for x in lines]), S.PAGE_RULES)
    outline = spark.range(1).select(S.joined_outline(marked).alias("o")).first().o
    assert "총칙" in outline and "목적" in outline and "①" in outline and not any(x in outline for x in ("글", "가 나", "다"))


def test_pages_of_laws_with_several_documents(spark, tmp_path):
    rng = random.Random(5)
    rows = [(rng.choice([1, 2, 3, 4, None]), ". ".join(rng.choice("abc") for _ in range(rng.randint(0, 15)))) for _ in range(30)] + [(9, None), (8, "")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    lines = exploded(I.law_texts(spark, str(tmp_path)), ["law_name"], F.split("text", "\n"), "i", "line")
    packed = lines.groupBy("law_name", F.floor(F.col("i") / 3).alias("page_no")).agg(F.array_sort(F.collect_list(F.struct("i", "line"))).alias("p"))
    want = packed.select("law_name", "page_no", F.array_join(F.transform("p", lambda x: x.line), "\n").alias("text"))
    got = I.law_pages(spark, str(tmp_path))
    assert got.schema.simpleString() == want.schema.simpleString()
    assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, want.collect()), key=str)
    last = got.groupBy("law_name").agg(F.max("page_no").alias("last"))
    assert exchanges(spark, paged._packed(got.join(last, "law_name").select("law_name", F.col("page_no").alias("blk"), "page_no", F.array("text").alias("t")), "t")) == 2


def test_a_stored_table_leaves_no_shuffle_files(spark):
    disk = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def shuffles():
        files = disk.getAllFiles()
        return {files.apply(i).getName() for i in range(files.size()) if files.apply(i).getName().startswith("shuffle_")}

    before, setting = shuffles(), spark.conf.get(staging.CLEAN_UP, None)
    rows, _ = staging.stored(spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count(), "counts")
    until = time.monotonic() + 20
    while shuffles() - before and time.monotonic() < until:
        time.sleep(0.2)
    assert not shuffles() - before and rows.count() == 7 and spark.conf.get(staging.CLEAN_UP, None) == setting
