"""URL filters: all glob rules at once over each canonical URL, by a bit-parallel automaton."""

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_CLASSES = 129  # one for each ASCII character, one for all others
_OTHER = 128


@dataclass(frozen=True)
class Rule:
    """host/path with a verdict: fits the host and all subdomains, and paths that start with `path`."""

    host: str
    path: str
    verdict: str

    @property
    def name(self) -> str:
        return self.host + self.path


@dataclass(frozen=True)
class Globs:
    """Patterns over the canonical URL: `*` any characters, `?` one character; everything else is itself."""

    block: tuple[str, ...]


class Automaton:
    """Shift-And over several machine words: one bit per pattern position, all patterns side by side.

    A pattern of m characters takes m + 1 bits: bit j says that its first j characters have been matched. A star after
    j characters lets bit j stay while it accepts the character read. A star written as '\\0' stands for host
    characters only and accepts everything but '/', '?' and '#'.
    """

    def __init__(self, patterns: list[str]):
        parsed = [self._parse(p) for p in patterns]
        total = sum(len(chars) + 1 for chars, _ in parsed)
        self.words = max(1, -(-total // 64))
        self.step = np.zeros((_CLASSES, self.words), np.uint64)
        self.stay = np.zeros((_CLASSES, self.words), np.uint64)
        self.first = np.zeros(self.words, np.uint64)
        self.last: list[int] = []
        at = 0
        for chars, stars in parsed:
            self._set(self.first, at)
            for j, c in enumerate(chars):
                for k in range(_CLASSES) if c is None else [min(ord(c), _OTHER)]:
                    self._set(self.step[k], at + j + 1)
            for j, host_only in stars.items():
                for k in range(_CLASSES):
                    if not (host_only and k < _OTHER and chr(k) in "/?#"):
                        self._set(self.stay[k], at + j)
            self.last.append(at + len(chars))
            at += len(chars) + 1

    @staticmethod
    def _parse(pattern: str) -> tuple[list, dict[int, bool]]:
        chars: list = []
        stars: dict[int, bool] = {}
        for c in pattern:
            if c in "*\0":
                stars[len(chars)] = c == "\0" and stars.get(len(chars), True)
            else:
                chars.append(None if c == "?" else c)
        return chars, stars

    @staticmethod
    def _set(mask: np.ndarray, bit: int) -> None:
        mask[bit // 64] |= np.uint64(1 << (bit % 64))

    def matches(self, texts: list[str]) -> np.ndarray:
        """(texts, patterns) booleans: the whole text fits the pattern. Longest texts first, so the live rows shrink."""
        order = sorted(range(len(texts)), key=lambda i: -len(texts[i]))
        lengths = np.array([len(texts[i]) for i in order], np.int64)
        codes = np.frombuffer("".join(texts[i] for i in order).encode("utf-32-le", "surrogatepass"), np.uint32)
        codes = np.minimum(codes, _OTHER).astype(np.uint8)
        begins = np.concatenate([[0], np.cumsum(lengths)])[:-1]
        state = np.tile(self.first, (len(texts), 1))
        for t in range(int(lengths.max(initial=0))):
            live = int(np.searchsorted(-lengths, -t))
            now, c = state[:live], codes[begins[:live] + t]
            moved = now << np.uint64(1)
            moved[:, 1:] |= now[:, :-1] >> np.uint64(63)
            state[:live] = (moved & self.step[c]) | (now & self.stay[c])
        out = np.zeros((len(texts), len(self.last)), bool)
        for p, bit in enumerate(self.last):
            out[order, p] = (state[:, bit // 64] >> np.uint64(bit % 64)) & np.uint64(1) == 1
        return out


def _literal(text: str) -> str:
    if re.search(r"[*?\0]", text):
        raise ValueError(f"a rule's host and path are plain text: {text!r}")
    return text


def split_url(url: str | None) -> tuple[str, str, str]:
    """Host (A-Z lower-cased), path, and the rest up to the fragment; all empty for NULL or without `://`."""
    _, found, rest = (url or "").partition("://")
    if not found:
        return "", "", ""
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host) :])[0]
    query = rest[len(host) + len(path) :].partition("#")[0]
    return re.sub("[A-Z]+", lambda m: m[0].lower(), host), path, query


def judge_urls(urls: DataFrame, rules: list[Rule], globs: Globs, id_column: str = "page_id", url_column: str = "url") -> DataFrame:
    """(page_id, host, path, rule, verdict, glob): one row per row of urls.

    The canonical URL is a dot, the host (A-Z lower-cased), the path and the query; scheme and fragment do not count.
    The longest rule (by host and path; of equally long ones the first given) decides; without one, any fitting block pattern blocks and
    everything else is allowed. NULL and malformed URLs have no host and path and are allowed unless a pattern fits the
    empty URL. Repeated rows are judged each; an empty table gives no rows; other columns are not read. The rules are a
    parameter that the caller writes down, so every task gets the masks; the work is linear in the length of the URLs.
    """
    ranked = sorted(rules, key=lambda r: -len(r.name))
    patterns = ["\0." + _literal(r.host) + _literal(r.path) + "*" for r in ranked] + list(globs.block)
    kind = urls.schema[id_column].dataType.simpleString()

    def judge(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        automaton = Automaton(patterns)
        for batch in batches:
            parts = [split_url(u) for u in batch["url"]]
            fits = automaton.matches(["." + "".join(p) for p in parts])
            out = []
            for row_id, (host, path, _), fit in zip(batch["page_id"], parts, fits):
                rule = next((r for r, ok in zip(ranked, fit) if ok), None)
                glob = next((g for g, ok in zip(globs.block, fit[len(ranked) :]) if ok), None)
                verdict = rule.verdict if rule else "block" if glob else "allow"
                out.append((row_id, host, path, rule.name if rule else None, verdict, glob))
            yield pd.DataFrame(out, columns=["page_id", "host", "path", "rule", "verdict", "glob"])

    rows = urls.select(F.col(id_column).alias("page_id"), F.col(url_column).cast("string").alias("url"))
    return rows.mapInPandas(judge, f"page_id {kind}, host string, path string, rule string, verdict string, glob string")
