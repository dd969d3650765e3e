"""Exact duplicates by an extendible-hash index kept in shared files."""

import functools
import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lawloom.llm.common import keep_decided, stored, text_of


def _key(text_column: str, key_bits: int) -> Column:
    """The upper `key_bits` bits of a 64-bit hash; the directory reads it from the top."""
    full = F.xxhash64(text_of(text_column))
    return full if key_bits == 64 else F.shiftleft(F.shiftrightunsigned(full, 64 - key_bits), 64 - key_bits)


def _prefix(depth: int, key: str = "key") -> Column:
    return F.shiftrightunsigned(key, 64 - depth)


def directory(keys: DataFrame, capacity: int = 4096, start_depth: int | None = None) -> tuple[DataFrame, int]:
    """((slot, bucket, depth), global depth): the bucket that each slot of the directory leads to.

    keys: one row per distinct `key`. The directory begins at the depth at which the mean bucket is half full and doubles as long as a
    bucket holds more than `capacity` keys; an overfull bucket alone is split by one more bit, and a bucket of a lesser depth
    has several slots. Buckets are numbered by their first slot, so their numbers ascend with the keys. Copies share a key, so no group of
    copies can overfill a bucket. Slots without keys are left out.
    """
    depth = start_depth or max(1, math.ceil(math.log2(max(keys.count(), 1) / (capacity / 2) + 1)))
    left, levels = keys, []
    while True:
        held = stored(left.groupBy(_prefix(depth).alias("prefix")).agg(F.count(F.lit(1)).alias("held")), "bucket-sizes")
        overfull = held.where(F.col("held") > capacity).select(F.col("prefix").alias("overfull"))
        levels.append((depth, held if depth == 64 else held.where(F.col("held") <= capacity)))
        if depth == 64 or overfull.isEmpty():
            break
        left = left.join(overfull, _prefix(depth) == F.col("overfull"), "left_semi")
        depth += 1
    parts = []
    for own, held in levels:
        first = F.shiftleft("prefix", depth - own)
        slots = F.sequence(first, first + F.lit((1 << (depth - own)) - 1))
        parts.append(held.select(F.explode(slots).alias("slot"), first.alias("bucket"), F.lit(own).alias("depth")))
    return stored(functools.reduce(DataFrame.unionByName, parts), "directory"), depth


def in_buckets(rows: DataFrame, slots: DataFrame, depth: int, broadcast_slots: int = 2**16) -> DataFrame:
    """rows with the `bucket` that the directory has for their key. A directory of up to `broadcast_slots` slots (24 bytes each) goes to all tasks."""
    slots = slots.select(F.col("slot").alias("own_slot"), "bucket")
    return rows.join(F.broadcast(slots) if 1 << depth <= broadcast_slots else slots, _prefix(depth) == F.col("own_slot")).drop("own_slot")


def chains(members: DataFrame) -> DataFrame:
    """(key, texts, owner): how many different texts a key holds. members: (bucket, key, text).

    Copies are first brought together by their bytes, in part before the shuffle, so a group of copies is one row however many there are.
    Then the rows of a bucket go to the task that owns its range of keys, where equal keys lie next to each other as a chain.
    """
    texts = members.groupBy("bucket", "key", "text").agg(F.lit(1).alias("one"))
    owned = texts.repartitionByRange("bucket").sortWithinPartitions("bucket", "key").withColumn("owner", F.spark_partition_id())
    return owned.groupBy("bucket", "key").agg(F.count(F.lit(1)).alias("texts"), F.max("owner").alias("owner"))


def _best(rows: DataFrame, *group: str) -> DataFrame:
    """Per group the largest id, a row that has it, and the number of rows; NULL ids are the smallest."""
    return rows.groupBy(*group).agg(
        F.max("doc_id").alias("keep_id"), F.coalesce(F.max_by("row_id", "doc_id"), F.max("row_id")).alias("keep_row"), F.count(F.lit(1)).alias("group_size")
    )


def exact_copies(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", capacity: int = 4096, key_bits: int = 64
) -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256, text_key): one row per row of docs.

    Texts are equal when identical; NULL counts as empty. Of equal texts the row with the largest id stays; NULL ids are
    the smallest, and of rows equal in id and text exactly one stays. An empty table gives no rows; other columns of
    docs are not read.

    The index holds each key once, with its bucket, and lies in shared files, a range of keys in each. Texts are read again only under keys
    that several rows share: the directory sends them to the owner of their key, which compares bytes. Where all rows of a key have one
    text, the key's entry in the index is their group, and rows find it by key, without their texts. Keys with several
    texts are grouped by text.
    """
    rows = docs.select(F.col(id_column).alias("doc_id"), text_of(text_column).alias("text"), _key(text_column, key_bits).alias("key"))
    digests = [F.sha2("text", 256).alias("text_sha256"), F.xxhash64("text").alias("text_key")]
    entries = stored(rows.select(F.monotonically_increasing_id().alias("row_id"), "doc_id", "key", *digests), "entries")
    keys = stored(_best(entries, "key"), "keys")
    slots, depth = directory(keys.select("key"), capacity)
    index = in_buckets(keys, slots, depth).repartitionByRange("bucket").sortWithinPartitions("bucket", "key")
    index = stored(index, "hash-index")
    shared = index.where("group_size > 1")
    members = rows.join(shared.select("key").hint("merge"), "key", "left_semi")
    members = stored(in_buckets(members.select("key", "text"), slots, depth), "chained-texts")  # the join stands alone, so a hot key's rows can be split
    chained = stored(chains(members), "chains")
    groups = shared.join(chained.select("key", "texts"), "key").select(F.col("key").alias("group_key"), "keep_id", "keep_row", "group_size", "texts")
    found = entries.join(groups.hint("merge"), F.col("key") == F.col("group_key"), "left").where("texts is null or texts = 1")
    alone = F.col("texts").isNull()
    found = found.select(
        "doc_id", F.when(alone, F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.when(alone, 1).otherwise(F.col("group_size")).cast("long").alias("group_size"), (alone | (F.col("row_id") == F.col("keep_row"))).alias("kept"),
        "text_sha256", "text_key",
    )
    colliding = chained.where("texts > 1").select("key")
    if colliding.isEmpty():
        return found
    apart = stored(rows.join(colliding.hint("merge"), "key", "left_semi").withColumn("row_id", F.monotonically_increasing_id()), "colliding-rows")
    apart = apart.join(_best(apart, "key", "text"), ["key", "text"])
    return found.unionByName(apart.select("doc_id", "keep_id", "group_size", (F.col("row_id") == F.col("keep_row")).alias("kept"), *digests))


def drop_copies(docs: DataFrame, **options) -> DataFrame:
    """docs without exact copies, with its own columns; see exact_copies for what stays."""
    names = {k: options[k] for k in ("id_column", "text_column") if k in options}
    return keep_decided(docs, exact_copies(docs, **options), **names)
