"""Language of documents and pages: text likelihoods fused with declared language, address suffix and host priors."""

import math
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lawloom.llm.common import mixed, stored, text_of
from lawloom.llm.spans import batches_of

OTHER = "und"
_LETTER = re.compile(r"[^\W\d_]+")


def _grams(texts: list[str], buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Bucket of each letter trigram (words set apart by blanks, lower-cased), and where each text's trigrams begin."""
    words = [" ".join(["", *_LETTER.findall(t.lower()), "", ""]) for t in texts]
    codes = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    lengths = np.array([len(w) for w in words], np.int64)
    begins = np.concatenate([[0], np.cumsum(lengths)])[:-1]
    grams = np.zeros(len(codes), np.int64)
    if len(codes) >= 3:
        packed = (codes[:-2] << np.uint64(42)) | (codes[1:-1] << np.uint64(21)) | codes[2:]
        grams[:-2] = (mixed(packed) % np.uint64(buckets)).astype(np.int64)
    ends = begins + lengths
    # the last two places of a text reach into the next one, and a text without letters is blanks only
    for back in (1, 2):
        grams[ends[lengths >= back] - back] = buckets
    grams[: len(codes)][(codes == 32) & (np.roll(codes, -1) == 32)] = buckets
    return grams, begins


def labelled_texts(docs: DataFrame, id_column: str, text_column: str, label_column: str, languages: list[str], per_language: int) -> DataFrame:
    """(label, text): at most per_language labelled texts of each language, those whose ids hash lowest."""
    ids = docs.select(F.col(id_column).alias("doc_id"), F.col(label_column).alias("label"), F.xxhash64(F.col(id_column)).alias("rank"))
    ids = ids.where(F.col("label").isin(languages))
    # hashes are even, so the lowest ones lie under a bound; only few rows more than wanted are then ranked
    bound = F.lit(None).cast("long")
    for row in ids.groupBy("label").count().collect():  # one row per language
        share = min(1.0, (per_language + 5 * math.sqrt(per_language)) / row["count"])
        bound = F.when(F.col("label") == row["label"], min(2**63 - 1, int(share * 2**64) - 2**63)).otherwise(bound)
    ids = ids.where(F.col("rank") <= bound)
    ids = ids.withColumn("n", F.row_number().over(Window.partitionBy("label").orderBy("rank", "doc_id"))).where(F.col("n") <= per_language)
    few = F.broadcast(ids.select(F.col("doc_id").alias("few_id")).distinct())  # at most per_language ids per language
    rows = docs.join(few, docs[id_column] == F.col("few_id"), "left_semi")
    return rows.select(F.col(label_column).alias("label"), text_of(text_column).alias("text"))


def fit_texts(labelled: DataFrame, languages: list[str], buckets: int, noise: float = 0.1) -> np.ndarray:
    """(buckets + 1, languages + 1) log likelihoods. The last column is a text of no known language: all trigrams alike.

    Each language has a share of `noise`, trigrams that might be any (names, keys, foreign words), so that a few odd ones
    cannot outweigh a text. Counting happens in the tasks; each sends one row of counts per language.
    """

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = np.zeros((len(languages), buckets + 1), np.int64)
        for batch in batches_of(batches, 512):
            for i, language in enumerate(languages):
                texts = batch["text"][batch["label"] == language].tolist()
                held[i] += np.bincount(_grams(texts, buckets)[0], minlength=buckets + 1)
        yield pd.DataFrame({"language": range(len(languages)), "counts": [row.astype(np.int32).tobytes() for row in held]})

    counts = np.zeros((len(languages), buckets))
    for row in labelled.coalesce(4).mapInPandas(count, "language int, counts binary").toLocalIterator():
        counts[row["language"]] += np.frombuffer(row["counts"], np.int32)[:buckets]
    table = np.zeros((buckets + 1, len(languages) + 1), np.float32)
    table[:buckets, :-1] = np.log((1 - noise) * counts / np.maximum(counts.sum(1, keepdims=True), 1) + noise / buckets).T
    table[:buckets, -1] = -np.log(buckets)
    return table


def _posterior(logs: Column) -> Column:
    """Normalised probabilities of an array of logarithms."""
    top = F.array_max(logs)
    weights = F.transform(logs, lambda x: F.exp(x - top))
    return F.transform(weights, lambda w: w / F.aggregate(weights, F.lit(0.0), lambda a, b: a + b))


def identify(
    docs: DataFrame, languages: list[str], id_column: str = "doc_id", text_column: str = "text", declared: Column | None = None,
    host: Column | None = None, labelled: DataFrame | None = None, label_column: str = "lang", per_language: int = 1000,
    buckets: int = 2**16, text_weight: float = 0.2, host_strength: float = 5.0, suffix_strength: float = 20.0, other_prior: float = 1e-3,
    min_posterior: float = 0.5,
) -> DataFrame:
    """(doc_id, language, posterior, accepted, text_language, n_grams, text_key, declared, host): one row per row of docs.

    Evidence, fused as log probabilities: the text under letter-trigram models (weighted by text_weight, since neighbouring trigrams
    are not independent); the declared language, by how often it goes with each text language; and a prior of
    the host, smoothed by that of the other hosts of its suffix (what follows its last dot), smoothed by that of all rows; a host
    without a dot is its own suffix and is smoothed by all rows alone. Priors are sums of text
    posteriors grouped by host, suffix and declared language over all rows, so a document's own share is small.
    Besides the languages there is `und`, with a prior of other_prior: letters that look like none of them. A row is accepted when a language other than `und`
    wins with at least min_posterior and the text has letters; NULL and empty texts have none and are rejected. NULL hosts and
    declarations are values of their own. Ties go to the language named first. Repeated rows are judged each, an empty
    table gives no rows, other columns are not read.

    labelled: (label, text) rows to learn from; by default at most per_language rows of docs per language, by label_column.
    Texts are read in one pass without a shuffle; grouping works on their scores, partially before the shuffle.
    """
    if labelled is None:
        labelled = labelled_texts(docs, id_column, text_column, label_column, languages, per_language)
    model = docs.sparkSession.sparkContext.broadcast(fit_texts(labelled, languages, buckets))  # fixed size: buckets times languages
    classes = [*languages, OTHER]
    kind = docs.schema[id_column].dataType.simpleString()
    empty = F.lit("")
    rows = docs.select(
        F.col(id_column).alias("doc_id"), text_of(text_column).alias("text"), F.xxhash64(text_of(text_column)).alias("text_key"),
        F.coalesce(declared.cast("string"), empty).alias("declared") if declared is not None else empty.alias("declared"),
        F.coalesce(host.cast("string"), empty).alias("host") if host is not None else empty.alias("host"),
    )

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches_of(batches, 256):
            grams, begins = _grams(batch["text"].tolist(), buckets)
            sums = np.add.reduceat(model.value[grams].astype(np.float64), begins, axis=0) if len(grams) else np.zeros((len(batch), len(classes)))
            n = np.add.reduceat((grams < buckets).astype(np.int64), begins) if len(grams) else np.zeros(len(batch), np.int64)
            yield pd.DataFrame({
                "doc_id": batch["doc_id"], "text_key": batch["text_key"], "declared": batch["declared"], "host": batch["host"],
                "n_grams": n, "logs": list(sums),
            })

    scored = stored(
        rows.mapInPandas(score, f"doc_id {kind}, text_key long, declared string, host string, n_grams long, logs array<double>"), "language-scores"
    )
    weighted = scored.withColumn("logs", F.transform(
        "logs", lambda x, i: x * text_weight + F.when(i == len(languages), float(np.log(other_prior))).otherwise(0.0)
    )).withColumn("suffix", F.substring_index("host", ".", -1))
    weighted = weighted.withColumn("p", _posterior(F.col("logs")))
    width = range(len(classes))

    def sums(frame: DataFrame, *keys: str) -> DataFrame:
        return frame.groupBy(*keys).agg(*(F.sum(F.when(F.col("n_grams") > 0, F.get("p", i)).otherwise(0.0)).alias(f"s{i}") for i in width))

    total = [F.col(f"s{i}") for i in width]
    all_sums = sums(weighted).first()  # one row, as wide as the languages
    all_sums = [(all_sums[i] or 0.0) + 1 for i in width]
    all_prior = F.array(*(F.lit(s / sum(all_sums)) for s in all_sums))

    def smoothed(prior: Column, strength: float, own: list[Column] = total) -> Column:
        return F.array(*((s + strength * F.get(prior, i)) / (sum(own, F.lit(0.0)) + strength) for i, s in enumerate(own)))

    by_host = stored(sums(weighted, "host", "suffix"), "host-sums")
    by_suffix = by_host.groupBy("suffix").agg(*(F.sum(f"s{i}").alias(f"s{i}") for i in width))
    by_suffix = by_suffix.select(F.col("suffix").alias("of_suffix"), *(F.col(f"s{i}").alias(f"of_suffix{i}") for i in width))
    hosts = by_host.join(by_suffix, F.col("suffix") == F.col("of_suffix"))
    # the host's own rows count at its own level only; what rounding leaves of them is no row
    others = [F.greatest(F.col(f"of_suffix{i}") - F.col(f"s{i}"), F.lit(0.0)) for i in width]
    hosts = hosts.withColumn("suffix_prior", smoothed(all_prior, suffix_strength, others))
    hosts = hosts.select(F.col("host").alias("of_host"), smoothed(F.col("suffix_prior"), host_strength).alias("host_prior"))
    said = sums(weighted, "declared")
    said = said.select(F.col("declared").alias("was_declared"), smoothed(all_prior, suffix_strength).alias("said_prior"))
    fused = weighted.join(hosts, F.col("host") == F.col("of_host")).join(said, F.col("declared") == F.col("was_declared"))
    # P(language | evidence) ~ text * P(language | host) * P(language | declared) / P(language)
    fused = fused.withColumn("fused", _posterior(F.transform(
        "logs", lambda x, i: x + F.log(F.get("host_prior", i)) + F.log(F.get("said_prior", i)) - F.log(F.get(all_prior, i))
    )))
    name = lambda p: F.element_at(F.array(*map(F.lit, classes)), F.array_position(p, F.array_max(p)).cast("int"))
    out = fused.withColumn("language", name(F.col("fused"))).withColumn("posterior", F.array_max("fused"))
    accepted = (F.col("language") != OTHER) & (F.col("posterior") >= min_posterior) & (F.col("n_grams") > 0)
    return out.select("doc_id", "language", "posterior", accepted.alias("accepted"), name(F.col("p")).alias("text_language"), "n_grams", "text_key", "declared", "host")


def keep_identified(docs: DataFrame, languages: list[str], declared: Column | None = None, host: Column | None = None, **options) -> DataFrame:
    """docs without the rows that identify rejects, with its own columns."""
    id_column, text_column = options.get("id_column", "doc_id"), options.get("text_column", "text")
    bad = identify(docs, languages, declared=declared, host=host, **options).where("not accepted")
    bad = bad.select(*(F.col(c).alias(f"__bad_{c}") for c in ("doc_id", "text_key", "declared", "host"))).distinct()
    empty = F.lit("")
    label = lambda c: F.coalesce(c.cast("string"), empty) if c is not None else empty
    same = (
        docs[id_column].eqNullSafe(F.col("__bad_doc_id")) & (F.xxhash64(text_of(text_column)) == F.col("__bad_text_key"))
        & (label(declared) == F.col("__bad_declared")) & (label(host) == F.col("__bad_host"))
    )
    return docs.join(bad, same, "left_anti")


def page_evidence(pages: DataFrame, url_column: str = "url", html_column: str = "html") -> DataFrame:
    """pages with `text` (markup taken out), `declared` (the lang attribute of the html element) and `host` of the address."""
    html = F.coalesce(F.col(html_column), F.lit(""))
    text = F.regexp_replace(F.regexp_replace(html, r"(?is)<(script|style)\b.*?</\1\s*>|<!--.*?-->", " "), r"(?s)<[^>]*>", " ")
    declared = F.lower(F.regexp_extract(html, r"""(?is)<html\b[^>]*?\blang\s*=\s*["']?([A-Za-z]+)""", 1))
    host = F.lower(F.regexp_extract(F.coalesce(F.col(url_column), F.lit("")), r"^[^:]*://([^/?#:]*)", 1))
    return pages.withColumns({"text": text, "declared": declared, "host": host})
