"""Benchmark passages in documents, by a prefix-filtered set join on word shingles."""

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lawloom.llm.common import WordHashes, key_filter, may_hold, shingle_hashes, stored, text_of

#: A word is a run of digits, ASCII letters and non-ASCII characters; A-Z are lower-cased.
_SEPARATORS = bytes(range(0x00, 0x30)) + bytes(range(0x3A, 0x41)) + bytes(range(0x5B, 0x61)) + bytes(range(0x7B, 0x80))
_FOLD = bytes.maketrans(_SEPARATORS + bytes(range(0x41, 0x5B)), b" " * len(_SEPARATORS) + bytes(range(0x61, 0x7B)))


def words_of(text: str) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(_FOLD).split()


def _joined(words: list[bytes]) -> str:
    return b" ".join(words).decode("utf-8", "surrogatepass")


def _signed(values: np.ndarray) -> list[int]:
    return values.view(np.int64).tolist()


def item_windows(items: DataFrame, id_column: str, text_column: str, window: int, shingle: int) -> DataFrame:
    """(item_id, words, size, keys): each window of an item; keys are the hashes of its shingles, in order.

    A window is `window` consecutive words; an item of fewer, but not none, is one window.
    """

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hashes = WordHashes()
        for batch in batches:
            out = []
            for item, text in zip(batch["item_id"], batch["text"]):
                words = words_of(text)
                size = min(window, len(words))
                if not size:
                    continue
                own = min(shingle, size)
                keys = shingle_hashes(hashes.of(words), own)
                for i in range(len(words) - size + 1):
                    out.append((item, _joined(words[i : i + size]), size, own, _signed(keys[i : i + size - own + 1])))
            yield pd.DataFrame(out, columns=["item_id", "words", "size", "shingle", "keys"])

    rows = items.select(F.coalesce(F.col(id_column).cast("string"), F.lit("")).alias("item_id"), text_of(text_column).alias("text"))
    return rows.mapInPandas(cut, "item_id string, words string, size int, shingle int, keys array<long>")


def benchmark_hits(
    docs: DataFrame, items: DataFrame, id_column: str = "doc_id", text_column: str = "text", item_id_column: str = "item_id",
    item_text_column: str = "text", window: int = 10, shingle: int = 5, filter_bits: int = 2**23,
) -> DataFrame:
    """(doc_id, n_words, n_hit, n_items, item_ids, text_key): one row per row of docs.

    A word is hit when it lies in any occurrence of an item's window. NULL or empty texts have no words; an empty
    table of documents gives no rows, an empty table of items no hits. Repeated rows are counted each for itself, NULL
    item ids count as one item with an empty name; other columns are not read.

    One pass over the documents notes the positions of shingles that occur in items (a bit array of fixed size decides
    first, so it may only note too many) with the words around them. All shingles of a window must be there, so a
    window needs just one of them as its prefix: the one noted least often over all documents. Windows and notes are joined on
    that key; position and length bounds follow from the shingle's place in the window; then the words are compared.
    """
    windows = stored(item_windows(items, item_id_column, item_text_column, window, shingle), "windows")
    sizes = sorted(r["shingle"] for r in windows.select("shingle").distinct().collect())  # at most `shingle` numbers
    bits = {n: key_filter(windows.where(F.col("shingle") == n).select(F.explode("keys").alias("key")), filter_bits) for n in sizes}
    shared_bits = docs.sparkSession.sparkContext.broadcast(bits)

    def note(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hashes, filters = WordHashes(), shared_bits.value
        for batch in batches:
            n_words, keys, positions, starts, around = [], [], [], [], []
            for text in batch["text"]:
                words = words_of(text)
                hashed = hashes.of(words) if filters else []
                key, pos, start, near = [], [], [], []
                for size, filt in filters.items():
                    run = shingle_hashes(hashed, size)
                    for p in np.flatnonzero(may_hold(run, filt)).tolist():
                        first = max(0, p - window + size)
                        key.append(int(run[p : p + 1].view(np.int64)[0]))
                        pos.append(p)
                        start.append(first)
                        near.append(_joined(words[first : p + window]))
                n_words.append(len(words))
                keys.append(key), positions.append(pos), starts.append(start), around.append(near)
            yield pd.DataFrame({
                "row_id": batch["row_id"], "doc_id": batch["doc_id"], "text_key": batch["text_key"], "n_words": n_words,
                "keys": keys, "positions": positions, "starts": starts, "around": around,
            })

    kind = docs.schema[id_column].dataType.simpleString()
    noted = stored(
        docs.select(
            F.monotonically_increasing_id().alias("row_id"), F.col(id_column).alias("doc_id"), text_of(text_column).alias("text"),
        ).withColumn("text_key", F.xxhash64("text")).mapInPandas(
            note,
            f"row_id long, doc_id {kind}, text_key long, n_words long, keys array<long>, positions array<int>, starts array<int>, around array<string>",
        ),
        "noted",
    )
    notes = stored(
        noted.where(F.size("keys") > 0).select("row_id", "n_words", F.inline(F.arrays_zip("keys", "positions", "starts", "around")))
        .withColumnsRenamed({"keys": "key", "positions": "pos", "starts": "first"}),
        "notes",
    )
    rarity = notes.groupBy("key").agg(F.count(F.lit(1)).alias("times"))
    distinct = windows.select("words", "size", "shingle", "keys").dropDuplicates(["words"])
    prefixes = distinct.select("words", "size", F.posexplode("keys").alias("offset", "key"))
    prefixes = prefixes.join(rarity, "key", "left").groupBy("words", "size").agg(
        F.min(F.struct(F.coalesce("times", F.lit(0)).alias("times"), "offset", "key")).alias("rarest")
    ).where("rarest.times > 0").select("words", "size", "rarest.offset", "rarest.key")
    at = F.col("pos") - F.col("offset")
    found = notes.join(prefixes, "key").where((at >= 0) & (at + F.col("size") <= F.col("n_words")))
    found = found.where(
        F.concat_ws(" ", F.slice(F.split("around", " "), (at - F.col("first") + 1).cast("int"), F.col("size"))) == F.col("words")
    ).select("row_id", "words", at.alias("at"), (at + F.col("size")).alias("end"))
    found = stored(found, "occurrences")
    covered = found.groupBy("row_id").agg(F.array_sort(F.collect_set(F.struct("at", "end"))).alias("runs")).select(
        "row_id",
        F.aggregate(
            "runs", F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).alias("until")),
            lambda acc, run: F.struct(
                (acc["n"] + F.greatest(run["end"] - F.greatest(run["at"], acc["until"]), F.lit(0))).alias("n"),
                F.greatest(acc["until"], run["end"]).alias("until"),
            ),
            lambda acc: acc["n"],
        ).alias("n_hit"),
    )
    named = found.select("row_id", "words").distinct().join(windows.select("item_id", "words").distinct(), "words")
    named = named.groupBy("row_id").agg(F.sort_array(F.collect_set("item_id")).alias("item_ids"))
    return (
        noted.select("row_id", "doc_id", "n_words", "text_key").join(covered, "row_id", "left").join(named, "row_id", "left")
        .select(
            "doc_id", "n_words", F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"),
            F.coalesce(F.size("item_ids").cast("long"), F.lit(0).cast("long")).alias("n_items"),
            F.coalesce("item_ids", F.array().cast("array<string>")).alias("item_ids"), "text_key",
        )
    )


def drop_contaminated(docs: DataFrame, items: DataFrame, **options) -> DataFrame:
    """docs without the documents that hold any benchmark window, with its own columns."""
    id_column, text_column = options.get("id_column", "doc_id"), options.get("text_column", "text")
    hit = benchmark_hits(docs, items, **options).where("n_hit > 0").select(
        F.col("doc_id").alias("__gone_id"), F.col("text_key").alias("__gone_key")
    ).distinct()
    same = docs[id_column].eqNullSafe(F.col("__gone_id")) & (F.xxhash64(text_of(text_column)) == F.col("__gone_key"))
    return docs.join(hit, same, "left_anti")
