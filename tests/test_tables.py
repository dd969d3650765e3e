"""Joins, numbers, carries, files: against plain Python on small tables with hot keys."""

import random

from pyspark.sql import functions as F

from lawloom.operators import carry, dedup, lookup, order
from lawloom.plans import collections as P
from lawloom.sources import readers, writers
from lawloom.streaming import arrivals


def rows_of_hot_key(n=900):
    rng = random.Random(3)
    out, at = [], {}
    for _ in range(n):
        k = rng.choice([0, 0, 0, 1, 2, 3])
        at[k] = at.get(k, -1) + 1
        out.append((k, at[k], rng.choice([None, None, None, f"v{rng.randint(0, 9)}"]), rng.random() < 0.3))
    return out


def test_carry_over_blocks(spark):
    rows = rows_of_hot_key()
    df = spark.createDataFrame(rows, "k int, pos long, v string, f boolean")
    filled = carry.fill_forward(df, ["k"], "pos", {"last": "v"}, block=16)
    counted = carry.running_count(filled, ["k"], "pos", "f", "n", block=16)
    last, count = {}, {}
    for k, pos, v, f in rows:
        last[k] = v if v is not None else last.get(k)
        count[k] = count.get(k, 0) + f
        rows[rows.index((k, pos, v, f))] = (k, pos, last[k], count[k])
    assert sorted((r.k, r.pos, r.last, r.n) for r in counted.collect()) == sorted(rows)


def test_row_index_and_first_rows(spark):
    rows = rows_of_hot_key()
    df = spark.createDataFrame(rows, "k int, pos long, v string, f boolean")
    got = order.row_index(df, "pos", "n", keys=("k",), start=5, block=16).collect()
    assert all(r.n == r.pos + 5 for r in got) and len(got) == len(rows)


def test_keep_first_and_lookup(spark):
    df = spark.createDataFrame([("a", 3, "x"), ("a", 1, "y"), (None, 0, "z"), ("b", 2, "w")], "k string, pos int, v string")
    assert {tuple(r) for r in dedup.keep_first(df, ["k"], "pos").collect()} == {("a", 1, "y"), (None, 0, "z"), ("b", 2, "w")}
    index = df.withColumnRenamed("k", "bdSeq")
    ids = lookup.selected_ids(index, ["a", "q", None])
    assert [tuple(r) for r in lookup.lookup(index, ids, ["pos"]).collect()] == [("a", 1, "y")]
    assert [r[0] for r in lookup.unmatched(index, ids).collect()] == ["q"]
    assert {r[0] for r in lookup.selected_ids(index, "all").collect()} == {"a", "b"}


def test_csv_forms(spark, tmp_path):
    rows = [("가,나", "줄\n둘", ""), ('따"옴', None, "끝")]
    df = spark.createDataFrame(rows, "a string, b string, c string")
    writers.write_csv(df.coalesce(1), str(tmp_path / "plain"))
    part = next((tmp_path / "plain").glob("*.csv")).read_bytes()
    assert part.startswith(b"\xef\xbb\xbfa,b,c\n") and b'""' not in part.split(b"\n", 1)[1].replace(b'""\xec\x98\xb4', b"")
    back = readers.read_case_table(spark, str(tmp_path / "plain" / "*.csv"))
    assert {tuple(r) for r in back.collect()} == {("가,나", "줄\n둘", None), ('따"옴', None, "끝")}
    writers.write_quoted_csv(df.coalesce(1), str(tmp_path / "quoted"))
    assert next((tmp_path / "quoted").glob("*.csv")).read_text().startswith('"a","b","c"\n')
    writers.write_json_lines(df, str(tmp_path / "json"))
    assert {tuple(r) for r in spark.read.json(str(tmp_path / "json")).select("a", "b", "c").collect()} == set(rows)
    assert not writers.write_if_any(df.where("a = 'x'"), str(tmp_path / "none")) and not (tmp_path / "none").exists()


def test_file_order_and_master(spark, tmp_path):
    lines = "\n".join(f"분류{i},제목{i},내용{i}" for i in range(300))
    (tmp_path / "zone.csv").write_text("대제목,소제목,현황\n" + lines, encoding="utf-8-sig")
    out = P.master_table(spark, {"REG_ZONE": str(tmp_path / "zone.csv")})
    got = [(r["index"], r.category, r.title, r.conditions) for r in out.orderBy("src_no", "ord").collect()]
    assert got == [(i + 1, f"분류{i}", f"제목{i}", "") for i in range(300)]


def test_unknown_format(spark):
    import pytest

    with pytest.raises(ValueError):
        readers.read_case_table(spark, "/x/y.xlsx")


def test_files_and_stream(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "갑법.txt").write_text("제1조(목적)\n① 가", encoding="utf-8")
    (folder / "을법.txt.crdownload").write_text("제1조\n나", encoding="utf-8")
    (folder / "x.PDF").write_bytes(b"x")
    assert [r.law_name for r in readers.list_files(spark, str(folder), readers.PDF_GLOB, recursive=True).collect()] == ["x"]
    rows = arrivals.arriving_rows(spark, str(folder))
    query = rows.writeStream.format("memory").queryName("arrived").option("checkpointLocation", str(tmp_path / "c")).start()
    query.processAllAvailable()
    query.stop()
    got = spark.table("arrived").collect()
    batch = P.law_corpus(readers.read_law_texts(spark, str(folder)))[0].collect()
    assert [tuple(r) for r in got] == [tuple(r) for r in batch] and [(r.law_name, r.text) for r in got] == [("갑법", "가")]


def test_case_flow(spark):
    cells = "<td>1</td><td>임시</td><td>회사</td><td><a data-bdseq='7'>서비스</a></td><td>-</td><td>20240131</td>"
    page = f'<table class="case table_col no_active"><tbody><tr>{cells}</tr></tbody></table>'
    lists = spark.createDataFrame([("FORM_002", 1, page), ("FORM_002", 2, "<p>없음</p>"), ("FORM_002", 3, page)], "form_code string, page_no int, html string")
    index = P.index_table(lists)
    url = "https://www.sandbox.or.kr/board/designated_case_edit.do?bdSeq=7"
    detail = "<table><tbody><tr><td><p><strong>내용</strong></p><p>본문-하나</p></td></tr></tbody></table>"
    pages = spark.createDataFrame([(url, detail), (url, detail)], "url string, html string")
    main, meta, unmatched, failed = P.selected_cases(index, pages, ["7", "8"])
    row = main.first()
    assert (row["서비스명"], row["서비스 내용"], main.count()) == ("서비스", "본문 하나", 1)
    assert meta.first()["src_서비스 내용"] == "strong" and meta.first()["extracted_columns"] == "서비스 내용"
    assert [r[0] for r in unmatched.collect()] == ["8"] and failed.count() == 0
