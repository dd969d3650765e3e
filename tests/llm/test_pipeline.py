import corpus_pipeline
from lawloom.llm import queries
from tests.llm.helpers import awkward, no_rows, prose, rows_of


def test_each_stage_decides_and_the_run_is_their_sequence(spark, tmp_path):
    passage = prose(500, 40)
    near = prose(600, 100)
    more = [
        (20, "漢字仮名交文字列一二三四五六七八九十" * 9, "zh", "src1"), (21, prose(21, 60), "en", "src2"), (22, prose(21, 60), "en", "src3"),
        (23, near, "en", "src1"), (24, near.replace(near.split()[50], "changed", 1), "en", "src1"), (25, f"{prose(25, 30)} {passage}", "en", "src7"),
        *((30 + i, prose(1000 + i, 80), "en", f"src{i % 20}") for i in range(60)),
    ]
    docs = awkward(spark, more)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, passage)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    now, seen = spark.read.parquet(f"{tmp_path}/documents.parquet"), []
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, now, str(tmp_path))
        assert out.columns[: len(docs.columns)] == docs.columns
        out.write.parquet(f"{tmp_path}/{i}")
        now = spark.read.parquet(f"{tmp_path}/{i}")
        seen.append({r["doc_id"] for r in rows_of(now)})
    language, exact, near_, clean, mixed = seen
    clean_ids = {21, 22, 23, 24, 25, *range(30, 90)}
    assert clean_ids <= language and not {2, 3, 8, 20} & language
    assert 22 in exact and 21 not in exact and {23, 24} <= exact
    assert 23 in near_ and 24 not in near_ and exact - near_ == {24}
    assert near_ - clean == {25}
    assert mixed <= clean and len(mixed) > 20
    key = lambda r: (str(r["doc_id"]), r["epoch"], r["take_tokens"])
    assert sorted(map(key, rows_of(corpus_pipeline.run(spark, str(tmp_path))))) == sorted(map(key, rows_of(now)))


def test_stages_take_empty_tables(spark, tmp_path):
    docs = no_rows(awkward(spark))
    spark.createDataFrame([(1, prose(1, 40))], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, str(tmp_path)).count() == 0


def test_one_query_per_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES) == list(range(1, 14))
