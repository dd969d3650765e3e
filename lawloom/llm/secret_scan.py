"""Secrets in texts: base patterns, and character Markov models of random strings against ordinary identifiers."""

import re
import string
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lawloom.llm.common import text_of
from lawloom.llm.spans import Kind, Span, base_spans, batches_of, digest, joined, sampled

_ASSIGN = re.compile(r"""((?ai:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
_WORDS = ("password", "passwd", "secret", "token", "api")


def _names_secret(text: str) -> bool:
    low = text.lower()
    return any(w in low for w in _WORDS)


KINDS = [
    Kind("assign", _ASSIGN, lambda m: len(m[2]) >= 6, _names_secret),
    Kind("access", re.compile(r"AKIA[A-Z0-9]+"), lambda m: len(m[0]) >= 20, lambda t: "AKIA" in t),
    # the same matches as all runs of [0-9a-f] with the short ones dropped
    Kind("hex", re.compile(r"[0-9a-f]{24,}"), lambda m: True, lambda t: True),
]
ORDER = ["assign", "access", "hex", "random"]
#: Words and plain numbers, which ordinary strings are learnt from.
_ORDINARY = re.compile(r"[A-Za-z_-]{6,}|(?<![A-Za-z0-9+/_=.-])[0-9]{6,}(?![A-Za-z0-9+/_=.-])")
CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{12,}")

_ALPHABET = string.ascii_lowercase + string.ascii_uppercase + string.digits + "+/_=-."
_CODES = np.full(256, len(_ALPHABET), np.uint8)
_CODES[np.frombuffer(_ALPHABET.encode(), np.uint8)] = np.arange(len(_ALPHABET))
_EDGE = len(_ALPHABET)  # begin and end of a string


def _transitions(values: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Codes of all pairs of neighbours, edges included, and where each value's pairs begin."""
    raw = np.frombuffer(("\n" + "\n".join(values) + "\n").encode("ascii"), np.uint8)
    codes = _CODES[raw].astype(np.int32)
    pairs = codes[:-1] * (_EDGE + 1) + codes[1:]
    lengths = np.array([len(v) + 1 for v in values], np.int64)
    return pairs, np.concatenate([[0], np.cumsum(lengths)])[:-1]


def train(values: list[str], strength: float = 5.0) -> np.ndarray:
    """log P(next | last) of a character Markov chain, as a flat table; pairs seen little lean on how common the next one is."""
    counts = np.zeros((_EDGE + 1) ** 2)
    if values:
        counts += np.bincount(_transitions(values)[0], minlength=len(counts))
    counts = counts.reshape(_EDGE + 1, _EDGE + 1)
    common = (counts.sum(0) + 0.5) / (counts.sum() + 0.5 * (_EDGE + 1))
    return np.log((counts + strength * common) / (counts.sum(1, keepdims=True) + strength)).ravel()


def generated(n: int, seed: int) -> list[str]:
    """Labelled random strings: seeded draws from the alphabets that keys and tokens use."""
    rng = np.random.default_rng(seed)
    alphabets = ["0123456789abcdef", string.ascii_letters + string.digits, string.ascii_letters + string.digits + "+/", string.ascii_uppercase + string.digits, string.ascii_letters + string.digits + "_-"]
    return ["".join(rng.choice(list(alphabets[i % len(alphabets)]), int(rng.integers(16, 65)))) for i in range(n)]


def labelled_strings(docs: DataFrame, id_column: str, text_column: str, sample_docs: int, sample_strings: int) -> DataFrame:
    """(value, is_random): strings of a bounded sample of documents; base matches are random, words and plain numbers ordinary."""

    def label(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for text in batch["text"]:
                base = base_spans(text, KINDS)
                out += [(m[2], True) for m in _ASSIGN.finditer(text) if len(m[2]) >= 16]
                out += [(text[a:b], True) for a, b, k in base if k != "assign"]
                out += [(m[0], False) for m in _ORDINARY.finditer(text) if all(m.end() <= a or b <= m.start() for a, b, _ in base)]
            yield pd.DataFrame(out, columns=["value", "is_random"])

    rows = sampled(docs, id_column, text_column, sample_docs).mapInPandas(label, "value string, is_random boolean").distinct()
    return rows.orderBy(F.xxhash64("value"), "value").limit(sample_strings)


def fit(labelled: DataFrame, drawn: int = 4000, seed: int = 5) -> np.ndarray:
    """Log-likelihood ratio of each pair of neighbours: random over ordinary. `labelled` is a bounded sample."""
    known = labelled.toPandas()
    is_random = known["is_random"].to_numpy(bool)
    values = known["value"].to_numpy(object)
    ordinary = [*values[~is_random]]
    return train([*values[is_random], *generated(drawn, seed)]) - train(ordinary + [v.upper() for v in ordinary[::4]])


def _pieces(text: str, base: list[Span]) -> Iterator[tuple[int, int]]:
    """What base spans leave of each candidate string; all of it when they touch none."""
    covered = sorted((a, b) for a, b, _ in base)
    for m in CANDIDATE.finditer(text):
        begin = m.start()
        for a, b in covered:
            if b > begin and a < m.end():
                if a > begin:
                    yield begin, a
                begin = b
        if begin < m.end():
            yield begin, m.end()


def random_spans(texts: list[str], bases: list[list[Span]], ratio: np.ndarray, threshold: float) -> list[list[Span]]:
    """Per text the pieces of candidate strings outside its base spans whose log-likelihood ratio reaches the threshold."""
    found = [(i, a, b) for i, (t, base) in enumerate(zip(texts, bases)) for a, b in _pieces(t, base)]
    out: list[list[Span]] = [[] for _ in texts]
    if found:
        pairs, begins = _transitions([texts[i][a:b] for i, a, b in found])
        scores = np.add.reduceat(ratio[pairs], begins)
        for k in np.flatnonzero(scores >= threshold).tolist():
            i, a, b = found[k]
            out[i].append((a, b, "random"))
    return out


def scan_secrets(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", sample_docs: int = 2000, sample_strings: int = 50_000,
    threshold: float = 12.0,
) -> DataFrame:
    """(doc_id, n_assign, n_access, n_hex, n_random, base_sha256, spans): one row per row of docs.

    Base patterns give their spans; every run of 12 or more key characters, or each piece that base spans leave of it, is scored by
    two character chains and is a span of kind `random` when it is `threshold` nats likelier under the chain of random strings. Offsets are code points, ends exclusive. The chains are
    learnt from at most sample_docs documents and sample_strings strings of them, and from seeded random strings;
    all documents and whole texts are scanned. NULL texts are empty and hold nothing; repeated rows are scanned each;
    an empty table gives no rows; other columns are not read. Scanning needs no shuffle.
    """
    ratio = fit(labelled_strings(docs, id_column, text_column, sample_docs, sample_strings))
    shared = docs.sparkSession.sparkContext.broadcast(ratio)  # a table of fixed size, about 40 KB
    kind = docs.schema[id_column].dataType.simpleString()

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches_of(batches, 512):
            texts = batch["text"].tolist()
            bases = [base_spans(text, KINDS) for text in texts]
            out = []
            for row_id, base, added in zip(batch["doc_id"], bases, random_spans(texts, bases, shared.value, threshold)):
                counts = [sum(k == name for _, _, k in base) for name in ORDER[:3]]
                out.append((row_id, *counts, len(added), digest(joined(base, ORDER)), joined(base + added, ORDER)))
            yield pd.DataFrame(out, columns=["doc_id", "n_assign", "n_access", "n_hex", "n_random", "base_sha256", "spans"])

    rows = docs.select(F.col(id_column).alias("doc_id"), text_of(text_column).alias("text"))
    return rows.mapInPandas(scan, f"doc_id {kind}, n_assign long, n_access long, n_hex long, n_random long, base_sha256 string, spans string")
