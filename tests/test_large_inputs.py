"""Queries on pages and files at size: work is dealt out evenly, and each tag's address is read once."""

from pathlib import Path

from pyspark.sql import functions as F

from checks import inputs as I
from lawloom.operators import tables
from lawloom.sources import readers


def documents(spark, folder, n=40):
    rows = spark.range(n).select(F.col("id").alias("doc_id"), F.lit("One. Two. Three.").alias("text"))
    rows.coalesce(1).write.parquet(f"{folder}/documents.parquet")
    return str(folder)


def test_pages_of_one_file_are_worked_on_by_many_tasks(spark, tmp_path):
    sf = documents(spark, tmp_path)
    for pages in (I.detail_pages(spark, sf), I.financial_list_pages(spark, sf)):
        assert pages.rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism
        assert pages.count() == 40


def test_law_files_lie_in_many_folders(spark, tmp_path):
    folder = Path(I.law_folder(spark, documents(spark, tmp_path)))
    assert len(list(folder.rglob("*.txt"))) == 40 and not list(folder.glob("*.txt"))


def test_first_link_in_the_order_of_places(spark):
    def link(html):
        return spark.createDataFrame([(html,)], "html string").select(tables.row_link(F.col("html"), base="b", token="/").alias("u")).first().u

    cells = "<td>1</td>" * 4
    assert link(f"<tr onclick=\"go(7)\">{cells}<td><a href='/x'>a</a></td></tr>") == "b7"
    assert link(f"<tr>{cells}<td><span><button onclick=\"go(8)\"></span></td><td><a href='/x'></td></tr>") == "b8"
    assert link("<tr><td><a href='#'>a</a><em onclick='x.do?id=9'></em></td></tr>") == "b9"
    assert link("<tr><td>none</td></tr>") is None


def test_law_files_are_listed_by_tasks(spark, tmp_path):
    """The driver plans without a file's name, and the rows are those of Spark's own reader."""
    contents = {
        "갑 법 100%+.txt": "가\r\n나".encode(), "empty.txt": b"", "bad.txt": b"\xff\xfe\x00a", "bom.txt": b"\xef\xbb\xbfb", "s/t/deep.txt": b"d",
        "s/갑 법 100%+.txt": b"again", "s/upper.TXT": b"u", "none": b"n", "y.txt.crdownload": b"c", "y.txt._COPYING_": b"c",
        "_h.txt": b"h", ".h.txt": b"h", "_k=v.txt": b"k", "_metadata.txt": b"m", "_metadata/q.txt": b"q", "_dir/q.txt": b"q", "_d=1/r.txt": b"r", ".dot/q.txt": b"q",
    }
    for name, content in contents.items():
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_bytes(content)
    (tmp_path / "link").symlink_to(tmp_path / "s/t")
    files = spark.read.text(str(tmp_path), wholetext=True, pathGlobFilter="*.txt", recursiveFileLookup=True)
    want = files.select(readers.file_stem(readers.metadata_path()).alias("law_name"), F.encode("value", "UTF-8").alias("b"))
    got = readers.read_law_texts(spark, f"file:{tmp_path}")
    assert got._jdf.queryExecution().optimizedPlan().collectLeaves().apply(0).nodeName() == "Range"
    assert sorted(map(tuple, got.select("law_name", F.encode("text", "UTF-8")).collect())) == sorted(map(tuple, want.collect()))
    assert got.count() == 9 and got.schema == files.select(F.col("value").alias("law_name"), F.col("value").alias("text")).schema
    assert sorted(r.law_name for r in readers.read_law_texts(spark, str(tmp_path), "?.txt").collect()) == ["q", "r"]
