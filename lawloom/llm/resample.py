"""Documents drawn so that they resemble a target: hashed word features, gains of their buckets, scores with Gumbel noise."""

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Regex
from tokenizers.pre_tokenizers import Split

from lawloom.llm.common import keep_decided, stored, text_of

#: A word is a run of digits, ASCII letters and non-ASCII characters.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def splitter() -> Split:
    """An untrained pre-tokeniser: keeps the words, with their offsets, and removes what is between them."""
    return Split(Regex(WORD), behavior="removed", invert=True)


def lowered(text: str) -> str:
    """A-Z in lower case; all other characters stay, so offsets hold for the text itself."""
    return text.encode().lower().decode()


class WordSums(dict):
    """crc32 of words; forgets all when it holds `limit` of them, so memory stays bounded."""

    def __init__(self, limit: int = 200_000):
        super().__init__()
        self.limit = limit

    def __missing__(self, word: str) -> int:
        if len(self) >= self.limit:
            self.clear()
        self[word] = s = zlib.crc32(word.encode())
        return s


def windows(text: str, longest: int, split: Split, sums: WordSums) -> tuple[np.ndarray, np.ndarray, int]:
    """(offsets, crcs, words) of a text: for each run of 1 to `longest` consecutive words its offset pair and the crc32 of its words joined by a space.

    Runs come by length, then by place. A longer run's crc goes on from that of the run without its last word.
    """
    tokens = split.pre_tokenize_str(lowered(text))
    n = len(tokens)
    offsets = np.array([o for _, o in tokens], np.int64).reshape(-1, 2)
    pairs, crcs = [offsets], [np.fromiter((sums[w] for w, _ in tokens), np.uint32, n)]
    for size in range(2, min(longest, n) + 1):
        starts, ends = offsets[: n - size + 1, 0], offsets[size - 1 :, 1]
        pairs.append(np.stack([starts, ends], 1))
        last = (b" " + w.encode() for w, _ in tokens[size - 1 :])
        crcs.append(np.fromiter((zlib.crc32(w, int(c)) for w, c in zip(last, crcs[-1])), np.uint32, n - size + 1))
    return np.concatenate(pairs), np.concatenate(crcs), n


def bucketed(docs: DataFrame, id_column: str, text_column: str, longest: int, buckets: int) -> DataFrame:
    """(doc_id, text_key, n_words, n_features, buckets): the bucket of each feature, packed as four-byte or two-byte numbers. Each text is cut once."""
    kind, width = docs.schema[id_column].dataType.simpleString(), np.uint16 if buckets <= 2**16 else np.uint32

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        split, sums = splitter(), WordSums()
        for batch in batches:
            for at in range(0, len(batch), 256):
                part = batch.iloc[at : at + 256]
                out = []
                for text in part["text"]:
                    _, crcs, n = windows(text, longest, split, sums)
                    out.append((n, len(crcs), (crcs % buckets).astype(width).tobytes()))
                found = pd.DataFrame(out, columns=["n_words", "n_features", "buckets"], index=part.index)
                yield pd.concat([part[["doc_id", "text_key"]], found], axis=1)

    rows = docs.select(F.col(id_column).alias("doc_id"), text_of(text_column).alias("text")).withColumn("text_key", F.xxhash64("text"))
    return stored(
        rows.select("doc_id", "text_key", "text").mapInPandas(cut, f"doc_id {kind}, text_key long, n_words long, n_features long, buckets binary"),
        "feature-buckets",
    )


def histogram(features: DataFrame, buckets: int) -> np.ndarray:
    """Features per bucket over all rows: a task adds its rows up first, and the driver gets one row per bucket."""
    width = np.uint16 if buckets <= 2**16 else np.uint32

    def add(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for packed in batch["buckets"]:
                total += np.bincount(np.frombuffer(packed, width), minlength=buckets)
        held = np.flatnonzero(total)
        yield pd.DataFrame({"bucket": held, "n": total[held]})

    sums = features.select("buckets").mapInPandas(add, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).toPandas()
    out = np.zeros(buckets, np.int64)
    out[sums["bucket"].to_numpy(np.int64)] = sums["n"].to_numpy(np.int64)
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 * ln of how much more of the target than of the source falls into a bucket), both smoothed by one feature a bucket."""
    s, t = source.astype(float), target.astype(float)
    n = len(s)
    return np.floor(1000 * np.log((t + 1) * (s.sum() + n) / ((s + 1) * (t.sum() + n)))).astype(np.int64)


def ranked(rows: DataFrame, most: int) -> DataFrame:
    """Adds `rank`, 1.. by falling score and then by doc_id, to the first `most` rows and NULL to the others; rows of one score may be many.

    The rows are dealt into ranges of (score, doc_id); a row's number is its place in its range and the sizes of those before.
    """
    order = [F.desc("score"), F.asc_nulls_last("doc_id")]
    placed = stored(rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("place", F.monotonically_increasing_id()), "placed")
    placed = placed.withColumn("range", F.shiftright("place", 33)).withColumn("inside", F.col("place") - F.shiftleft(F.col("range"), 33))
    before = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    ranges = placed.groupBy("range").agg(F.count(F.lit(1)).alias("held")).select("range", F.coalesce(F.sum("held").over(before), F.lit(0)).alias("before"))
    rank = F.col("before") + F.col("inside") + 1
    return placed.join(ranges, "range").withColumn("rank", F.when(rank <= most, rank)).drop("place", "range", "inside", "before")


def importance_sample(
    docs: DataFrame, target: DataFrame, id_column: str = "doc_id", text_column: str = "text", target_id_column: str = "item_id",
    target_text_column: str = "text", longest: int = 1, buckets: int = 10000, seed: int = 2024, percent: int = 10, least_words: int = 20,
) -> DataFrame:
    """(doc_id, n_words, n_features, weight, score, rank, text_key): one row per row of docs; rank is NULL where a row is not drawn.

    A row's weight is the floored mean of the gains of its features' buckets (0 without features); its score adds Gumbel noise that
    its id and the seed fix, so the highest scores are a draw without replacement in proportion to exp(weight / 1000). Of the rows
    with at least least_words words the highest `percent` in a hundred, rounded down, are drawn; ties go to the smaller id,
    NULL ids last (their noise is that of an empty id). NULL texts have no words. Repeated rows are rows of their own and get ranks of
    their own. Without rows there is no result; an empty target gives weights by the source alone. Other columns are not read.

    What comes to the driver is fixed: a row per bucket, and a row per distinct score. Gains lie within 44,000 of 0 and noise within
    -3,200 and 22,300, so there are at most some 114,000 scores.
    """
    features = bucketed(docs, id_column, text_column, longest, buckets)
    wanted = bucketed(target, target_id_column, target_text_column, longest, buckets)
    shared = docs.sparkSession.sparkContext.broadcast(gains(histogram(features, buckets), histogram(wanted, buckets)))  # 8 bytes a bucket
    kind, width = docs.schema[id_column].dataType.simpleString(), np.uint16 if buckets <= 2**16 else np.uint32

    def weigh(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            held = (np.frombuffer(b, width) for b in batch["buckets"])
            weight = [int(shared.value[h].sum()) // len(h) if len(h) else 0 for h in held]
            yield batch.drop(columns="buckets").assign(weight=np.array(weight, np.int64))

    weighed = features.mapInPandas(weigh, f"doc_id {kind}, text_key long, n_words long, n_features long, weight long")
    named = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(named, 256), 1, 8), 16, 10).cast("long")
    noise = F.floor(F.lit(-1000.0) * F.log(-F.log((h + F.lit(0.5)) / F.lit(2.0**32))))
    scored = stored(weighed.withColumn("score", F.col("weight") + noise), "scores")
    may = F.col("n_words") >= least_words
    counts = scored.where(may).groupBy("score").agg(F.count(F.lit(1)).alias("n")).toPandas().sort_values("score", ascending=False)
    most = int(counts["n"].sum()) * percent // 100
    if not most:
        return scored.withColumn("rank", F.lit(None).cast("long"))
    last = int(counts["score"].to_numpy()[np.searchsorted(counts["n"].to_numpy().cumsum(), most)])
    rest = scored.where(~may | (F.col("score") < last)).withColumn("rank", F.lit(None).cast("long"))
    return ranked(scored.where(may & (F.col("score") >= last)), most).unionByName(rest)


def drawn_documents(docs: DataFrame, target: DataFrame, **options) -> DataFrame:
    """The rows of docs that importance_sample draws, with their own columns; of rows equal in id and text one or all stay."""
    names = {k: options[k] for k in ("id_column", "text_column") if k in options}
    sample = importance_sample(docs, target, **options)
    return keep_decided(docs, sample.select("doc_id", "text_key", F.col("rank").isNotNull().alias("kept")), **names)
