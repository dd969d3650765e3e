"""Outputs in a stated order, written from one pass over the pages; rejects; page numbers that are missing or too long."""

import random

from pyspark.sql import functions as F

from lawloom.operators import carry, listing, manifest, paged
from lawloom.plans import collections as P
from lawloom.sources import readers, staging, writers


def read_back(spark, folder):
    """Rows of CSV files in the order of the files' names."""
    return [tuple(r) for f in sorted(folder.glob("*.csv")) for r in spark.read.csv(str(f), header=True, multiLine=True, escape='"').collect()]


def test_files_in_name_order_hold_rows_in_order(spark, tmp_path):
    rows = [("k" if i % 3 else f"k{i}", i, f"v{i}") for i in range(5000)]
    random.Random(1).shuffle(rows)
    df = spark.createDataFrame(rows, "key string, ord long, v string").repartition(6)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    writers.write_csv(writers.in_file_order(df, "key", "ord"), f"{tmp_path}/out", bom=False)
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(list((tmp_path / "out").glob("*.csv"))) > 2
    assert read_back(spark, tmp_path / "out") == [(k, str(o), v) for k, o, v in sorted(rows)]


def test_a_hot_law_and_many_small_ones_give_few_files(spark, tmp_path):
    rows = [("hot", i, "x") for i in range(4000)] + [(f"law{i}", j, "y") for i in range(60) for j in range(3)]
    random.Random(2).shuffle(rows)
    df = spark.createDataFrame(rows, "law_name string, ord long, text string").repartition(8)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    writers.write_per_law(df, f"{tmp_path}/laws", order=("ord",), rows_per_file=1000)
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    files = {d.name: len(list(d.glob("*.csv"))) for d in (tmp_path / "laws").iterdir() if d.is_dir()}
    assert len(files) == 61 and files["_law=hot"] > 1
    assert sum(files.values()) <= 61 + 8 + 4  # laws, ranges, and what rows_per_file adds
    assert [int(r[1]) for r in read_back(spark, tmp_path / "laws/_law=hot")] == list(range(4000))


DETAIL = "<table><tbody><tr><td><p><strong>기대효과</strong> 좋음 {}</p></td></tr></tbody></table>"


def test_each_selected_page_is_parsed_once(spark, tmp_path):
    index = spark.createDataFrame(
        [(str(i), "FORM_002", 1, i, f"u{i}", f"{i}번", "구분", "회사", f"서비스 {i}", "2024-01-01", "글") for i in range(12)],
        ["bdSeq", "form_code", "page_no", "pos", "detail_url", "번호", "구분", "기업명", "서비스명", "designated_date", "list_td_text"],
    )
    parsed = spark.sparkContext.accumulator(0)

    def seen(html):
        parsed.add(1)
        return html

    pages = spark.createDataFrame([(f"u{i}", DETAIL.format(i)) for i in range(12) if i != 4], "url string, html string")
    pages = pages.withColumn("html", F.udf(seen).asNondeterministic()("html"))
    counts = P.save_selected(index, pages, str(tmp_path), "r1", ids=["9", "2", "4", "nope", "2", "7"])
    assert counts == {"n_rows": 4, "n_failed": 1}
    main = read_back(spark, tmp_path / "selected_r1_csv")
    assert [r[0].removesuffix("번") for r in main] == ["9", "2", "4", "7"]  # the order in which they were asked for
    assert [r[8] for r in main] == ["좋음 9", "좋음 2", None, "좋음 7"]
    assert [r[0] for r in read_back(spark, tmp_path / "selected_rejects_r1")] == ["4"]
    assert spark.read.json(str(tmp_path / "selected_meta_r1_jsonl")).count() == 4
    assert parsed.value <= 11  # every page at most once, with four outputs, two counts and the rejects
    none = P.save_selected(index, pages, str(tmp_path), "r2", ids=["nope"])
    assert not none.get("n_rows") and not (tmp_path / "selected_r2_csv").exists()


def test_special_law_list_and_normalised_tables(spark, tmp_path):
    pages = spark.createDataFrame([(2, "2. 나법", "ㅇ 관계 법령: 다\nㅇ 규제 특례 사항 라"), (1, "1) 가법", "x")], "pos long, title string, pre string")
    P.save_special_laws(pages, str(tmp_path), "r")
    assert [r[:2] for r in read_back(spark, tmp_path / "special_laws_r")] == [("가법", "x"), ("나법", "다")]
    (tmp_path / "law.csv").write_text("순번,사업명\n2,가\n1,나\n", "utf-8")
    (tmp_path / "fin.csv").write_text("서비스명\n바\n사\n", "utf-8")
    P.save_master(spark, {"IND_LAW": str(tmp_path / "law.csv"), "FIN": str(tmp_path / "fin.csv")}, str(tmp_path / "out"), each=True)
    assert [r[3] for r in read_back(spark, tmp_path / "out/master")] == ["바", "사", "가", "나"]
    assert [r[3] for r in read_back(spark, tmp_path / "out/normalized_ind_law")] == ["가", "나"]
    names = manifest.law_names(spark.createDataFrame([(3, " 가 "), (1, ""), (2, "나")], "n long, name string"), "name", pos="n")
    assert sorted(map(tuple, names.collect())) == [("가", 3), ("나", 2)]


def test_uneven_lines_are_rejects(spark, tmp_path):
    (tmp_path / "in.csv").write_text('a,b\n1,"x,\ny"\n2\n3,p,q\n4,\n', "utf-8")
    rows, rejects = readers.read_with_rejects(spark, str(tmp_path / "in.csv"), ["a", "b"])
    assert sorted(map(tuple, rows.collect()), key=str) == [("1", "x,\ny"), ("4", None)]
    assert sorted((r.line, r.reason) for r in rejects.collect()) == [("2", "too few cells"), ("3,p,q", "too many cells")]
    assert rejects.first().file.endswith("in.csv")


def test_a_page_that_repeats_ends_the_paging(spark):
    rng = random.Random(3)
    shown = {(g, p): rng.choice("abc") for g in ("x", None) for p in range(400)}
    before = {r.p: r for r in carry.previous(
        spark.createDataFrame([(g, p * 7, v) for (g, p), v in shown.items() if g], "g string, p long, v string"), ["g"], "p", "v", "b", block=16).collect()}
    assert all(before[p * 7].b == (shown["x", p - 1] if p else None) for p in range(400))
    pages = spark.createDataFrame([("x", i, 3, s) for i, s in enumerate("abacca")] + [("y", 1, 2, "q"), ("y", 2, 0, "r")], "g string, p long, n int, s string")
    kept = listing.pages_before_stop(pages, "g", "p", "n", signature="s")
    assert sorted((r.g, r.p) for r in kept.collect()) == [("x", 0), ("x", 1), ("x", 2), ("x", 3), ("y", 1)]


def test_pages_without_a_number_and_long_numbers(spark):
    rows = [("갑", 0, "제1조(가)\n하나"), ("갑", None, "둘"), ("을", 5, "제99999999999999999999조(다)\n다섯"), ("을", 4, "제3조(다)\n여섯")]
    got = paged.segment_pages(spark.createDataFrame(rows, "law_name string, page_no int, text string"), pages_per_block=2)
    assert sorted((r.law_name, r.article_number, r.text) for r in got.collect()) == [
        ("갑", "제1조", "하나 둘"), ("을", "제3조", "여섯 제99999999999999999999조(다) 다섯"),
    ]


def test_stored_rows_are_worked_out_once(spark):
    kept, seen = staging.stored(spark.range(10).where("id > 3"), "rows", n=F.count(F.lit(1)), top=F.max("id"))
    assert seen == {"n": 6, "top": 9} and kept.count() == 6 and "ExistingRDD" not in kept._jdf.queryExecution().toString()
