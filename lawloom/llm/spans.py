"""Spans in texts: base patterns, joining, digests; shared by the personal-data and secret scans."""

import hashlib
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lawloom.llm.common import text_of

Span = tuple[int, int, str]


@dataclass(frozen=True)
class Kind:
    """A base pattern: leftmost matches that do not overlap; those that `keep` refuses are dropped.

    hint: says quickly that a text cannot hold a match; it must never be wrong.
    """

    name: str
    pattern: re.Pattern
    keep: Callable[[re.Match], bool]
    hint: Callable[[str], bool]


def base_spans(text: str, kinds: list[Kind]) -> list[Span]:
    found = []
    for kind in kinds:
        if kind.hint(text):
            found += [(m.start(), m.end(), kind.name) for m in kind.pattern.finditer(text) if kind.keep(m)]
    return found


def joined(spans: list[Span], order: list[str]) -> str:
    """kind:start:end by start, then by kind as listed, then by end."""
    rank = {name: i for i, name in enumerate(order)}
    return ",".join(f"{k}:{a}:{b}" for a, b, k in sorted(spans, key=lambda s: (s[0], rank[s[2]], s[1])))


def digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def uncovered(spans: list[Span], base: list[Span]) -> list[Span]:
    """Those that overlap no base span; the longest first, none overlapping an earlier one."""
    kept: list[Span] = []
    for a, b, k in sorted(set(spans), key=lambda s: (s[0] - s[1], s)):
        if all(b <= c or d <= a for c, d, _ in base + kept):
            kept.append((a, b, k))
    return kept


def sampled(docs: DataFrame, id_column: str, text_column: str, rows: int) -> DataFrame:
    """(text): at most `rows` texts, those whose ids hash lowest.

    The hash that takes in so many is found from the ids alone; only the texts up to it are read on.
    """
    rank = F.xxhash64(F.col(id_column))
    last = docs.select(rank.alias("rank")).orderBy("rank").limit(rows).agg(F.max("rank")).first()[0]
    return docs.where(rank <= F.lit(last)).select(text_of(text_column).alias("text")).limit(rows)


def batches_of(batches: Iterator, rows: int) -> Iterator:
    """Smaller pandas batches, so that what a task makes of one stays small."""
    for batch in batches:
        for at in range(0, len(batch), rows):
            yield batch.iloc[at : at + rows]
