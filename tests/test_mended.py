"""Inputs that the derived tables lack: odd file names, page tails, nested tables, relative links, sparse positions, NULL keys."""

from pyspark.sql import functions as F

from lawloom.functions import markup
from lawloom.operators import carry, fields, lawhtml, listing, lookup, normalize, order, segment, tables
from lawloom.plans import collections as P
from lawloom.sources import readers, writers
from lawloom.streaming import arrivals


def one(spark, text, column):
    return spark.createDataFrame([(text,)], "html string").select(column.alias("x")).first().x


def test_law_files_are_read_whole_under_their_names(spark, tmp_path):
    folder = tmp_path / "laws"
    folder.mkdir()
    names = ["개인정보 보호법", "100% 법+시행령", "갑법"]
    text = "제1장 총칙\n제1조(목적)\n이 법은\n① 가\n② 나\n제2조(정의)\n뜻"
    for name in names:
        (folder / f"{name}.txt").write_text(f"{name}\n{text}", encoding="utf-8")
    (folder / "을법.txt.crdownload").write_text("제1조\n나", encoding="utf-8")
    want = sorted(
        (n, o, "제1장 총칙", *r) for n in names
        for o, r in enumerate([("제1조", "목적", "①", "가"), ("제1조", "목적", "②", "나"), ("제1조", "목적", None, "이 법은"), ("제2조", "정의", None, "뜻")])
    )
    batch = segment.segment(readers.read_law_texts(spark, str(folder)))
    columns = ["law_name", "ord", "chapter", "article_number", "article_title", "clause_number", "text"]
    assert sorted(map(tuple, batch.select(columns).collect()), key=str) == sorted(want, key=str)
    query = arrivals.arriving_rows(spark, str(folder)).writeStream.format("memory").queryName("whole_files")
    query = query.option("checkpointLocation", str(tmp_path / "c")).start()
    query.processAllAvailable()
    query.stop()
    assert sorted(map(tuple, spark.table("whole_files").select(columns).collect()), key=str) == sorted(want, key=str)


def test_a_group_ends_with_its_block(spark):
    page = (
        '<div class="pgroup"><div><p class="pty1_p4"><label>제1조(목적)</label> ① 가</p></div><p>② 나</p></div><div class="foot"><p>담당부서 안내</p></div>'
    )
    rows = lawhtml.law_html_rows(spark.createDataFrame([("갑", page)], "law_name string, html string")).orderBy("ord").collect()
    assert [r.text for r in rows] == ["가", "나"]
    unclosed = '<div class="pgroup"><p class="pty1_p4"><label>제1조(목적)</label> ① 가</p>'
    assert lawhtml.law_html_rows(spark.createDataFrame([("갑", unclosed)], "law_name string, html string")).first().text == "가"


def test_sections_take_siblings_only(spark):
    page = (
        "<div><p><strong>기대효과</strong></p><p>좋음</p><table><tr><td><p>표 안 글</p></td></tr></table><p>더</p></div><div><p>밖</p></div>"
        "<p><strong>규제</strong> : 있음</p>"
    )
    got = one(spark, page, fields.strong_sections(F.col("html"), F.lit(None).cast("string")))
    assert [(s.header, s.body) for s in got] == [("기대효과", "좋음 더"), ("규제", "있음")]


def test_links_are_unescaped_and_absolute(spark):
    base = "https://sandbox.fintech.or.kr/business/enterprise.do?lang=ko&id="
    links = ['<a href="/business/enterprise.do?lang=ko&amp;id=5">', f'<a href="{base}6">', '<a href="enterprise.do?lang=ko&amp;id=7">', '<a href="//x.kr/enterprise.do">', '<a href="?enterprise.do">']
    got = [one(spark, f"<tr><td>1</td>{a}", tables.row_link(F.col("html"), page_url=base)) for a in links]
    assert got == [base + "5", base + "6", base + "7", "https://x.kr/enterprise.do", "https://sandbox.fintech.or.kr/business/enterprise.do?enterprise.do"]


def test_entities(spark):
    html = "a &middot; b &lsquo;c&rsquo; &#8226; &#x27; &#x1F600; &amp;middot; &unknown; &#60;i&#62; &#xD800; R&D &lt;b&gt;"
    assert one(spark, html, markup.flow_text(markup.prepare(F.col("html")))) == "a · b ‘c’ • ' \U0001f600 &middot; &unknown; <i> &#xD800; R&D <b>"


def test_dates_without_zeros_are_compared(spark):
    df = spark.createDataFrame([("2023-1-5",), ("2024-1-5",), ("2024-01-05",), ("미정",), ("2023-1-5x",)], "d string")
    kept = [r.d for r in df.where(listing.in_date_range(F.col("d"), since="2024-01-01")).collect()]
    assert kept == ["2024-1-5", "2024-01-05", "미정", "2023-1-5x"]


def test_numbers_and_carries_keep_all_rows(spark):
    step = 10**9 + 7
    rows = [(k, i * step, i % 5 == 0, f"v{i}" if i % 7 == 0 else None) for k in ("a", None) for i in range(300)] + [("a", None, True, "w"), (None, None, False, None)]
    df = spark.createDataFrame(rows, "k string, pos long, f boolean, v string")
    got = {(r.k, r.pos): r for r in order.row_index(df, "pos", "n", keys=("k",)).collect()}
    assert len(got) == len(rows) and got["a", None].n is None
    assert all(got[k, i * step].n == i + 1 for k in ("a", None) for i in range(300))
    alone = order.row_index(df.where("k = 'a'"), "pos").where("pos is not null").orderBy("pos").collect()
    assert [r["index"] for r in alone] == list(range(1, 301))
    filled = carry.fill_forward(carry.running_count(df, ["k"], "pos", "f", "c"), ["k"], "pos", {"last": "v"})
    for r in filled.collect():
        if r.pos is None:
            assert r.c is None and r.last == r.v
        else:
            i = r.pos // step
            assert (r.c, r.last) == (i // 5 + 1, f"v{i // 7 * 7}")
    assert filled.count() == len(rows)


def test_index_cells(spark):
    df = spark.createDataFrame([("1",), ("1.0",), (" 2 ",), ("12-1",), (None,), ("",)], "index string")
    assert [r["index"] for r in normalize.conform(df).collect()] == [1, 1, 2, None, None, None]
    assert [tuple(r) for r in normalize.odd_indexes(df).collect()] == [("12-1", "index is not a whole number")]


def test_selection_keeps_its_order_and_rows_without_link_stay(spark):
    index = spark.createDataFrame([("b", 1, "u1"), ("a", 2, None), ("c", 3, "u3"), ("a", 4, "u1")], "bdSeq string, pos long, detail_url string")
    ids = lookup.ordered_ids(spark, ["c", "a", None, "zz", "c", "b"])
    found = lookup.in_order(lookup.lookup(index, ids, ["pos"]), ids)
    assert [r.bdSeq for r in found.orderBy("selected_pos").collect()] == ["c", "a", "b"]
    assert [r[0] for r in lookup.unmatched(index, ids.select("bdSeq")).collect()] == ["zz"]
    pages = spark.createDataFrame([("u1", "<p>x"), ("u1", "<p>y"), (None, "<p>n"), ("other", "z")], "url string, html string")
    joined = {r.bdSeq: r.html for r in lookup.with_detail_page(found, pages).collect()}
    assert joined["a"] is None and joined["c"] is None and joined["b"] in ("<p>x", "<p>y")


def test_writers(spark, tmp_path):
    df = spark.createDataFrame([("갑 법", "제1조", 'a "b"\nc'), ("을법", None, "")], "law_name string, article_number string, text string")
    writers.write_per_law(df, f"{tmp_path}/per")
    back = spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(f"{tmp_path}/per")
    assert {(r._law, r.text) for r in back.collect()} == {("갑 법", 'a "b"\nc'), ("을법", None)}
    raw, clean = writers.write_raw_and_clean(df, df.limit(1), str(tmp_path), "cases", "7")
    assert raw.endswith("cases_raw_7") and readers.read_case_table(spark, f"{clean}/*.csv").count() == 1
    assert P is not None


def test_odd_indexes_are_saved_beside_the_master_table(spark, tmp_path):
    (tmp_path / "law.csv").write_text("순번,사업명\n1,가\n12-1,나\n1234567890123456789,다\n", "utf-8")
    (tmp_path / "case.csv").write_text("번호,제목\n7,라\n7a,마\n", "utf-8")
    (tmp_path / "fin.csv").write_text("서비스명\n바\n", "utf-8")
    paths = {"IND_LAW": str(tmp_path / "law.csv"), "IND_CASE": str(tmp_path / "case.csv"), "FIN": str(tmp_path / "fin.csv")}
    P.save_master(spark, paths, str(tmp_path / "out"))
    odd = spark.read.csv(str(tmp_path / "out/master_odd_indexes"), header=True).select("sandbox_type", "index_text").collect()
    assert sorted(map(tuple, odd)) == [("IND_CASE", "7a"), ("IND_LAW", "12-1"), ("IND_LAW", "1234567890123456789")]
    assert spark.read.csv(str(tmp_path / "out/master"), header=True).count() == 6
