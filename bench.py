"""Times the headline queries and prints one JSON line.

The given tables hold one row group each, and Spark cannot split a row group: a query without an exchange would run in one task. So
the tables are first copied, untimed, to a fresh folder with many row groups, as a large table has them; the queries read the copy.
"queries" are first runs (planning and compilation count), "cpu" the JVM's CPU seconds in them; with BENCH_WARM=1 "warm" and
"warm_cpu" are second runs.
"""

import json
import os
import sys
import tempfile
import time
from pathlib import Path

import pyarrow.parquet as pq

sys.path.insert(0, str(Path(__file__).resolve().parent))

from checks.queries import QUERIES  # noqa: E402
from lawloom.session import local_session  # noqa: E402

HEADLINE = [
    "text_clean", "text_sanitize", "text_keep_law", "first_sentence",
    "law_lines", "law_segment", "law_segment_loose", "law_segment_pages", "clause_split",
    "law_html_rows", "html_blocks", "html_links", "html_list_rows", "detail_links",
    "strong_sections", "kv_pairs", "field_fallback", "financial_fields", "case_rows", "two_headings",
    "master_union", "row_index", "index_filter", "select_lookup", "detail_join", "missing_files",
    "retry_outcomes", "page_stop", "dedup_keep_first", "kv_last_wins",
]
ROW_GROUPS, LEAST_ROWS = 64, 128


def with_row_groups(folder: str) -> str:
    """A copy of the tables with up to ROW_GROUPS row groups each, none of fewer than LEAST_ROWS rows but the last."""
    copy = tempfile.mkdtemp(prefix="bench-tables-")
    for path in sorted(Path(folder).glob("*.parquet")):
        table = pq.read_table(path)
        pq.write_table(table, f"{copy}/{path.name}", row_group_size=max(LEAST_ROWS, -(-table.num_rows // ROW_GROUPS)))
    return copy


def cpu_seconds(pid: int) -> float:
    fields = Path(f"/proc/{pid}/stat").read_text().rsplit(")", 1)[1].split()
    return (int(fields[11]) + int(fields[12])) / os.sysconf("SC_CLK_TCK")


def timed(spark, name: str, folder: str, pid: int) -> tuple[float, float]:
    """Wall seconds, and CPU seconds of the JVM."""
    start, used = time.perf_counter(), cpu_seconds(pid)
    QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
    return round(time.perf_counter() - start, 3), round(cpu_seconds(pid) - used, 2)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    copy = with_row_groups(folder)
    spark = local_session(int(os.environ.get("BENCH_CPUS", "8")), "bench")
    spark.sparkContext.setLogLevel("ERROR")
    pid = spark.sparkContext._jvm.ProcessHandle.current().pid()
    spark.read.parquet(f"{copy}/nation.parquet").count()
    first = {name: timed(spark, name, copy, pid) for name in HEADLINE}
    out = {
        "metric": "headline queries, total wall time", "value": round(sum(s for s, _ in first.values()), 3), "unit": "sec",
        "queries": {n: s for n, (s, _) in first.items()}, "sf": Path(folder).name.removeprefix("sf"), "cpu": {n: c for n, (_, c) in first.items()},
    }
    if os.environ.get("BENCH_WARM") == "1":
        second = {name: timed(spark, name, copy, pid) for name in HEADLINE}
        out |= {"warm": {n: s for n, (s, _) in second.items()}, "warm_cpu": {n: c for n, (_, c) in second.items()}}
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
