"""Row numbers of files: by a row's own place in Parquet, by splits elsewhere."""

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import functions as F

from lawloom.operators import order


def numbers(df):
    return {r.v: r["index"] for r in order.file_row_index(df).collect()}


def test_parquet_rows_have_their_own_place(spark, tmp_path):
    at = 0
    for name, rows, group in [("a", 1000, 64), ("b", 0, 1), ("c", 1, 1), ("d", 777, 100)]:
        pq.write_table(pa.table({"v": pa.array(range(at, at + rows), pa.int64())}), tmp_path / f"{name}.parquet", row_group_size=group)
        at += rows
    df = spark.read.parquet(str(tmp_path))
    assert order.has_row_places(df)
    assert numbers(df) == {v: v + 1 for v in range(at)}
    plan = order.file_row_index(df)._jdf.queryExecution().optimizedPlan().toString()
    assert "file_block_start" not in plan and "monotonically_increasing_id" not in plan


def test_text_rows_by_split(spark, tmp_path):
    for k, name in enumerate("ab"):
        (tmp_path / f"{name}.csv").write_text("".join(f"{k * 50 + i}\n" for i in range(50)))
    df = spark.read.schema("v long").csv(str(tmp_path))
    assert not order.has_row_places(df)
    assert numbers(df) == {v: v + 1 for v in range(100)}
    assert order.file_row_index(df, "n", 0).agg(F.min("n")).first()[0] == 0


def test_empty_table(spark, tmp_path):
    pq.write_table(pa.table({"v": pa.array([], pa.int64())}), tmp_path / "a.parquet")
    assert numbers(spark.read.parquet(str(tmp_path))) == {}
