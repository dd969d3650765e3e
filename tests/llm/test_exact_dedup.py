from collections import Counter, defaultdict

from pyspark.sql import functions as F

from lawloom.llm import exact_dedup
from lawloom.llm.exact_dedup import drop_copies, exact_copies
from tests.llm.helpers import awkward, no_rows, prose, rows_of


def expected(docs):
    groups = defaultdict(list)
    for r in rows_of(docs):
        groups[r["text"] or ""].append(r["doc_id"])
    best = lambda ids: max((i for i in ids if i is not None), default=None)
    return sorted(((i, best(ids), len(ids)) for ids in groups.values() for i in ids), key=str)


def test_copies_match_grouping_and_one_row_stays(spark):
    docs = awkward(spark, [(20 + i, prose(77, 12), "en", "s") for i in range(40)])
    for options in ({}, {"key_bits": 2, "capacity": 1}, {"key_bits": 6, "capacity": 3}):
        got = rows_of(exact_copies(docs, **options))
        assert sorted(((r["doc_id"], r["keep_id"], r["group_size"]) for r in got), key=str) == expected(docs)
        kept = [r["text_sha256"] for r in got if r["kept"]]
        assert len(kept) == len(set(kept)) == len({r["text"] or "" for r in rows_of(docs)})


def test_directory_doubles_until_buckets_hold(spark):
    keys = spark.range(2000).select(F.xxhash64("id").alias("key"))
    slots, depth = exact_dedup.directory(keys, capacity=50, start_depth=1)
    buckets = {r["bucket"]: r["depth"] for r in rows_of(slots)}
    assert max(buckets.values()) == depth and min(buckets.values()) < depth and len(rows_of(slots)) > len(buckets)
    placed = rows_of(exact_dedup.in_buckets(keys, slots, depth))
    assert len(placed) == 2000
    assert rows_of(exact_dedup.in_buckets(keys, slots, depth, broadcast_slots=1).orderBy("key")) == sorted(placed, key=lambda r: r["key"])
    held = Counter(r["bucket"] for r in placed)
    assert max(held.values()) <= 50
    for r in placed:
        own = buckets[r["bucket"]]
        assert (r["key"] & (2**64 - 1)) >> (64 - own) == r["bucket"] >> (depth - own)


def test_a_range_of_keys_is_chained_by_one_task(spark):
    rows = spark.range(0, 3000, 1, 6).select(F.xxhash64(F.col("id") % 900).alias("key"), F.concat(F.lit("t"), (F.col("id") % 1800).cast("string")).alias("text"))
    slots, depth = exact_dedup.directory(rows.select("key").distinct(), capacity=20)
    members = exact_dedup.in_buckets(rows, slots, depth)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    found = rows_of(exact_dedup.chains(members))
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    unsigned = lambda k: k & (2**64 - 1)
    ranges = defaultdict(list)
    for r in found:
        ranges[r["owner"]].append(unsigned(r["key"]))
    assert len({r["bucket"] for r in found}) > len(ranges) > 1
    assert len({(r["bucket"], r["owner"]) for r in found}) == len({r["bucket"] for r in found})
    spans = sorted((min(k), max(k)) for k in ranges.values())
    assert all(a[1] < b[0] for a, b in zip(spans, spans[1:]))
    assert {(r["key"], r["texts"]) for r in found} == {(r["key"], 2) for r in rows_of(rows)}


def test_no_text_in_a_join_of_clean_keys(spark):
    docs = awkward(spark, [(20 + i, prose(77, 12), "en", "s") for i in range(40)])
    plan = exact_copies(docs)._jdf.queryExecution().toString()
    joins = [line for line in plan.split("\n") if "Join" in line]
    assert joins and not any("text#" in line for line in joins)


def test_stage_keeps_columns_and_one_of_each(spark):
    docs = awkward(spark)
    out = drop_copies(docs)
    assert out.columns == docs.columns
    texts = [r["text"] or "" for r in rows_of(out)]
    assert sorted(texts) == sorted({r["text"] or "" for r in rows_of(docs)})
    assert drop_copies(no_rows(docs)).count() == exact_copies(no_rows(docs)).count() == 0
