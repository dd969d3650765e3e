"""What several training-data operators need: stored tables, text access, row decisions, word hashes."""

import tempfile
import uuid

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: ASCII blanks; every other character belongs to a word.
BLANKS = r"\x20\x09-\x0D"
WORD = rf"[^{BLANKS}]+"


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir of the session.

    Only a local session, as in tests, may leave it unset; it then gets a folder of its own.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named and spark.sparkContext.master.startswith("local["):
        named = tempfile.mkdtemp(prefix="lawloom-shared-")
        spark.conf.set("spark.checkpoint.dir", named)
    if not named:
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return named.rstrip("/")


def stored(df: DataFrame, name: str) -> DataFrame:
    """The rows of df, written once to the shared folder and read from there.

    It cuts the lineage and survives lost executors; later uses read the files instead of working df out again.
    """
    path = f"{shared_folder(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def text_of(column: str = "text") -> Column:
    """A text column, with NULL as the empty text."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def word_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD)).cast("long")


def text_key(column: str = "text") -> Column:
    """64-bit key of a text, to tell rows of one id apart."""
    return F.xxhash64(text_of(column))


def keep_decided(docs: DataFrame, decisions: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The rows of docs that `decisions` (doc_id, text_key, kept: one row per row of docs) keeps, with docs' own columns.

    Rows equal in id and text cannot be told apart: of them as many as are kept remain (one or all).
    Only the rows that go are joined, and no column is added to docs, so names cannot clash.
    """
    changed = stored(
        decisions.groupBy(F.col("doc_id").alias("__gone_id"), F.col("text_key").alias("__gone_key"))
        .agg(F.sum(F.col("kept").cast("long")).alias("__kept"), F.count(F.lit(1)).alias("__rows"))
        .where(F.col("__kept") < F.col("__rows")),
        "changed-rows",
    )
    same = docs[id_column].eqNullSafe(F.col("__gone_id")) & (text_key(text_column) == F.col("__gone_key"))
    rest = docs.join(changed.hint("merge"), same, "left_anti")
    repeated = changed.where(F.col("__kept") > 0)
    if repeated.isEmpty():
        return rest
    one = docs.join(repeated, same, "left_semi")
    key = next(f"__key{i}" for i in range(len(docs.columns) + 1) if f"__key{i}" not in docs.columns)
    one = one.withColumn(key, text_key(text_column)).dropDuplicates([id_column, key]).drop(key)
    return rest.unionByName(one)


class WordHashes(dict):
    """64-bit hashes of words as bytes; forgets all when it holds `limit` of them, so memory stays bounded."""

    def __init__(self, limit: int = 200_000):
        super().__init__()
        self.limit = limit

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.limit:
            self.clear()
        self[word] = h = xxhash.xxh64_intdigest(word)
        return h

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.array([self[w] for w in words], dtype=np.uint64)


def mixed(h: np.ndarray) -> np.ndarray:
    """Spreads the bits of 64-bit values."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def shingle_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """Hash of each run of `size` neighbours in an array of word hashes."""
    n = len(words) - size + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    h = np.full(n, size, np.uint64)
    for i in range(size):
        h = mixed(h * np.uint64(0x9E3779B97F4A7C15) + words[i : i + n])
    return h


def key_filter(keys: DataFrame, filter_bits: int) -> np.ndarray:
    """Bit array of a fixed size with two bits per key: at most filter_bits / 64 rows come to the driver, however many keys there are."""
    bits = keys.select(F.explode(F.array(
        F.pmod(F.col("key"), F.lit(filter_bits)), F.pmod(F.shiftrightunsigned("key", 32), F.lit(filter_bits)),
    )).alias("bit"))
    words = bits.groupBy(F.shiftright("bit", 6).alias("word")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(pmod(bit, 64) as int))")).alias("mask")
    ).toPandas()
    out = np.zeros(filter_bits // 64, np.int64)
    out[words["word"].to_numpy(np.int64)] = words["mask"].to_numpy(np.int64)
    return out.view(np.uint64)


def may_hold(keys: np.ndarray, bits: np.ndarray) -> np.ndarray:
    """Which keys a key_filter may hold; those that it holds are never missed."""
    n = np.uint64(len(bits) * 64)
    found = np.ones(len(keys), bool)
    for at in (keys % n, (keys >> np.uint64(32)) % n):
        found &= (bits[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63))) & np.uint64(1) == 1
    return found
