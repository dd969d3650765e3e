"""Financial and free-zone flows from pages to rows."""

from lawloom.plans import collections as P


def test_financial_flow(spark, tmp_path):
    base = "https://sandbox.fintech.or.kr/business/enterprise.do?lang=ko&id="
    row = "<tr><td>1</td><td>회사</td><td>서비스</td><td>-</td><td><button onclick=\"goView('{}')\">보기</button></td></tr>"
    listing = "<table><thead><tr><th>No</th><th>기업</th></tr></thead><tbody>" + row.format(5) + row.format(6) + "</tbody></table>"
    detail = (
        "<table><tbody><tr><th>지정 제도</th><td>●혁신</td></tr><tr><th>서비스명</th><td>간편 결제</td></tr>"
        "<tr><th>규제 특례 내용</th><td>해당 없음</td></tr></tbody></table>"
    )
    lists = spark.createDataFrame([(1, listing), (9, listing)], "page_no int, html string")
    pages = spark.createDataFrame([(base + "5", detail)], "url string, html string")
    raw, clean, failed = P.financial_cases(lists, pages, max_pages=2)
    assert [(r["지정 제도"], r["서비스명"], r["규제 특례 내용"]) for r in raw.collect()] == [("●혁신", "간편 결제", "")]
    assert clean.first()["지정 제도"] == "혁신"
    assert [(r.key, r.error) for r in failed.collect()] == [(base + "6", "no detail page")]


def test_zone_flow_keeps_first_of_equal_rows(spark):
    block = "<p>[가]</p><p>현황: 나</p><p>☞ 다 허용</p>"
    rows = [
        (1, 0, "10차 - 구역", "h4", "실증특례 배달", True),
        (1, 1, "10차 - 구역", "div", block, True),
        (1, 2, "10차 - 구역", "div", block, True),
        (1, 3, "10차 - 구역", "h4", "숨은 제목", False),
        (1, 4, "10차 - 구역", "div", "<p>현황 라</p>", True),
        (1, 5, "10차 - 구역", "h4", "", True),
        (1, 6, "10차 - 구역", "div", block, True),
    ]
    df = spark.createDataFrame(rows, "page_id long, pos long, title string, tag string, html string, is_visible boolean")
    got = [tuple(r)[:5] for r in P.zone_cases(df).orderBy("ord").collect()]
    assert got == [("구역", "배달", "가", "나", "다 허용"), ("구역", "배달", "현황 라", "라", "")]  # a label cuts the subtitle only with its closing bracket


def test_reclean(spark, tmp_path):
    (tmp_path / "in.csv").write_text("a,b\n●가,나<LAW>\n", encoding="utf-8-sig")
    P.reclean(spark, str(tmp_path / "in.csv"), str(tmp_path / "out"))
    assert next((tmp_path / "out").glob("*.csv")).read_text(encoding="utf-8") == '"a","b"\n"가","나"\n'
