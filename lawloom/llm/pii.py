"""Personal data in texts: base patterns, and a character tagger for the forms that they miss."""

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lawloom.llm.common import text_of
from lawloom.llm.spans import Span, batches_of, digest, joined, sampled, uncovered
from lawloom.llm.tagger import Tagger, char_classes

ORDER = ["email", "ip", "card", "phone"]
_DOMAIN = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
_LOCAL = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")
# a match can only begin where a run of digits does
_IP = re.compile(r"(?<![0-9])[0-9]++((?:\.[0-9]++){3})")
_CARD = re.compile(r"(?<![0-9])[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
#: Seven digits close together, or an at sign written in some way, may be personal data in a form without a base pattern.
_DOUBTFUL = re.compile(r"[0-9](?:[^A-Za-z]{0,3}[0-9]){6,}|@|[(\[]at[)\]]")
_HINT = re.compile(r"[0-9@]")
#: How the at sign is written in the forms that the tagger learns.
_AT = re.compile(r"@|[(\[]at[)\]]")
#: What any span of the tagger holds, see _plausible.
_TELLING = re.compile(r"[0-9]|" + _AT.pattern)


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches of `[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\\.[A-Za-z0-9-]+)+`, found from their @ so that long words cost no more."""
    end = 0
    for m in _DOMAIN.finditer(text):
        start = m.start()
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        if start < m.start():
            end = m.end()
            yield start, end


def _small(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) < 3 or len(part) == 3 and int(part) <= 255


def luhn(digits: str) -> bool:
    values = [int(d) for d in reversed(digits)]
    return (sum(values[::2]) + sum(sum(divmod(2 * d, 10)) for d in values[1::2])) % 10 == 0


def _digits(text: str) -> str:
    return re.sub("[^0-9]", "", text)


def base_spans(text: str) -> list[Span]:
    if not _HINT.search(text):
        return []
    out = [(a, b, "email") for a, b in _emails(text)] if "@" in text else []
    out += [(m.start(), m.end(), "ip") for m in _IP.finditer(text) if all(map(_small, m[0].split(".")))]
    out += [(m.start(), m.end(), "card") for m in _CARD.finditer(text) if 14 <= len(d := _digits(m[0])) <= 19 and luhn(d)]
    if "+" in text:
        out += [(m.start(), m.end(), "phone") for m in _PHONE.finditer(text) if 10 <= len(_digits(m[0])) <= 15]
    return out


def _draw(kind: str, rng: np.random.Generator, words: list[str]) -> str:
    """A labelled string of a kind, in forms with and without a base pattern; kind "" is a number that is no personal data."""
    n = lambda k: "".join(map(str, rng.integers(0, 10, k)))
    pick = lambda xs: xs[int(rng.integers(len(xs)))]
    word = lambda: re.sub("[^a-z]", "", pick(words).lower()) or "mail"
    if kind == "email":
        user, host, end = pick([word(), f"{word()}.{n(2)}", f"{word()}_{word()}"]), word(), pick(["com", "org", "net", "de", "example.com"])
        return pick([f"{user}@{host}.{end}", f"{user} @ {host}.{end}", f"{user}(at){host}.{end}", f"{user}{n(2)} [at] {host}.{end}", f"{user}@{host} . {end}"])
    if kind == "ip":
        parts = [str(x) for x in rng.integers(0, 256, 4)]
        return pick([".", ".", " . ", "[.]"]).join(parts)
    if kind == "card":
        body = n(15)
        d = next(body + str(x) for x in range(10) if luhn(body + str(x)))
        return pick(["", "", " ", "-", ".", "/"]).join(d[i : i + 4] for i in range(0, 16, 4))
    if kind == "phone":
        a, b, c = n(3), n(3), n(4)
        return pick([f"+1 ({a}) {b}-{c}", f"({a}) {b}-{c}", f"{a}-{b}-{c}", f"{a}.{b}.{c}", f"+49 {n(3)} {n(7)}", f"0{n(2)} {n(4)} {n(4)}", f"tel:{a}{b}{c}"])
    return pick([n(4), f"20{n(2)}-0{n(1)}-1{n(1)}", f"{n(2)}:{n(2)}", f"{n(1)}.{n(5)}", f"v{n(1)}.{n(1)}.{n(2)}", n(7), f"{n(2)}.{n(3)}.{n(3)}",
                 "".join(pick("0123456789abcdef") for _ in range(40)), f"{n(2)} {n(3)}", f"no. {n(5)}", f"{n(3)}%"])


def labelled_windows(docs: DataFrame, id_column: str, text_column: str, sample_docs: int, sample_windows: int, size: int, seed: int) -> DataFrame:
    """(window, tags): windows of a bounded sample of documents with a digit per character, 0 or the kind's place in ORDER plus 1.

    Spans of the base patterns are labels; windows with other digits or at signs that may be personal data are left out, since nothing is known
    of them. Seeded strings of each kind and plain numbers are put between words.
    """

    def label(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for text in batch["text"]:
                rng = np.random.default_rng([seed, len(text), *text[:20].encode()])
                words = [w for w in text.split() if not _HINT.search(w) and not _DOUBTFUL.search(w)][:200] or ["text"]
                tags = np.zeros(len(text), np.uint8)
                for a, b, k in base_spans(text):
                    tags[a:b] = ORDER.index(k) + 1
                spots = [a for a, _, _ in base_spans(text)] + [int(rng.integers(0, len(text) + 1))]
                for spot in spots[:6]:
                    a = max(0, spot - int(rng.integers(0, size)))
                    window, known = text[a : a + size], tags[a : a + size]
                    if all(known[m.start() : m.end()].any() for m in _DOUBTFUL.finditer(window)):
                        out.append((window, "".join(map(str, known))))
                for kind in [*ORDER, *ORDER, "", ""]:
                    mark = str(ORDER.index(kind) + 1) if kind else "0"
                    drawn, at = _draw(kind, rng, words), int(rng.integers(0, len(words)))
                    left, right = " ".join(words[max(0, at - 12) : at]), " ".join(words[at : at + 12])
                    whole = f"{left} {drawn} {right}"
                    marks = "0" * (len(left) + 1) + mark * len(drawn) + "0" * (len(right) + 1)
                    if drawn.startswith("tel:"):
                        marks = marks[: len(left) + 1] + "0000" + marks[len(left) + 5 :]
                    a = max(0, len(left) + 1 - int(rng.integers(0, size - 4)))
                    out.append((whole[a : a + size], marks[a : a + size]))
            yield pd.DataFrame(out, columns=["window", "tags"])

    with_digits = docs.where(text_of(text_column).rlike("[0-9@]"))
    rows = sampled(with_digits, id_column, text_column, sample_docs).unionByName(sampled(docs, id_column, text_column, sample_docs // 2))
    return rows.mapInPandas(label, "window string, tags string").orderBy(F.xxhash64("window"), "window", "tags").limit(sample_windows)


def fit(labelled: DataFrame, hidden: int, size: int, updates: int, seed: int) -> Tagger | None:
    """A tagger learnt from (window, tags) rows, a bounded sample; none without rows."""
    rows = labelled.toPandas()
    if not len(rows):
        return None
    codes, gold = np.zeros((len(rows), size), np.uint8), np.zeros((len(rows), size), np.uint8)
    for i, (window, tags) in enumerate(zip(rows["window"], rows["tags"])):
        codes[i, : len(window)] = char_classes(window)[:size]
        gold[i, : len(tags)] = np.frombuffer(tags.encode(), np.uint8)[:size] - ord("0")
    tagger = Tagger(len(ORDER) + 1, hidden, seed)
    tagger.train(codes, gold, updates, 64, 0.02, seed)
    return tagger


def _plausible(text: str, kind: str) -> bool:
    digits = len(_digits(text))
    if kind == "email":
        return bool(_AT.search(text)) and "." in text and digits < 12
    least, most = {"ip": (4, 12), "card": (14, 19), "phone": (9, 15)}[kind]
    return least <= digits <= most and (kind != "ip" or len(re.findall("[0-9]+", text)) == 4)


def _stretches(windows: set[int]) -> list[tuple[int, int]]:
    """Runs of neighbouring windows, as (first, last)."""
    order = sorted(windows)
    edges = [k for k in range(1, len(order)) if order[k] > order[k - 1] + 1]
    return [(order[a], order[b - 1]) for a, b in zip([0, *edges], [*edges, len(order)])] if order else []


def tagged_spans(texts: list[str], tagger: Tagger, size: int, overlap: int, rows: int = 1024, every: bool = False) -> list[list[Span]]:
    """Per text the spans of the tagger.

    Windows of `size` characters overlap by `overlap`. Neighbouring windows make a stretch: where they overlap, what they say for each tag is
    averaged, a place counting for more the farther it is from a window's edge, and the transitions then find one best path
    through the whole stretch. A span that _plausible lets through holds a match of _TELLING, so stretches begin with the windows of those
    matches and grow by their neighbours as long as a tag reaches their border. `every` takes all windows, so each text is one stretch.
    """
    step = size - overlap
    last = [max(0, -(-(len(text) - overlap) // step) - 1) for text in texts]
    weight = np.minimum(np.arange(size), np.arange(size)[::-1]).astype(np.float32)[:, None] + 1
    chosen: list[set[int]] = []
    for text, end in zip(texts, last):
        held = {min(end, max(0, m.start() - overlap // 2) // step) for m in _TELLING.finditer(text)}
        chosen.append(set(range(end + 1)) if every and text else held)
    said: dict[tuple[int, int], np.ndarray] = {}
    closed: set[tuple[int, int, int]] = set()
    out: list[list[Span]] = [[] for _ in texts]
    changed = [i for i, held in enumerate(chosen) if held]
    while changed:
        todo = [(i, w) for i in changed for w in sorted(chosen[i]) if (i, w) not in said]
        for at in range(0, len(todo), rows):
            part = todo[at : at + rows]
            codes = np.zeros((len(part), size), np.uint8)
            for k, (i, w) in enumerate(part):
                own = char_classes(texts[i][w * step : w * step + size])
                codes[k, : len(own)] = own
            said.update(zip(part, tagger.emissions(codes).copy()))
        runs = [(i, a, b) for i in changed for a, b in _stretches(chosen[i]) if (i, a, b) not in closed]
        runs.sort(key=lambda r: r[2] - r[1])
        grown = set()
        for at in range(0, len(runs), 64):
            part = runs[at : at + 64]
            lengths = np.array([min(len(texts[i]), b * step + size) - a * step for i, a, b in part])
            e = np.zeros((len(part), lengths.max(), tagger.tags), np.float32)
            for k, (i, a, b) in enumerate(part):
                total = np.zeros((lengths[k], 1), np.float32)
                for w in range(a, b + 1):
                    place = slice((w - a) * step, min((w - a) * step + size, lengths[k]))
                    n = place.stop - place.start
                    e[k, place] += said[i, w][:n] * weight[:n]
                    total[place] += weight[:n]
                e[k, : lengths[k]] /= total
            for (i, a, b), n, path in zip(part, lengths, tagger.best_paths(e, lengths)):
                more = {a - 1} if a and path[0] else set()
                more |= {b + 1} if b < last[i] and path[n - 1] else set()
                if more:
                    chosen[i] |= more
                    grown.add(i)
                else:
                    closed.add((i, a, b))
                    out[i] += _read_spans(texts[i], path[:n], a * step)
        changed = sorted(grown)
    return out


def _read_spans(text: str, tags: np.ndarray, start: int) -> list[Span]:
    """The plausible spans among runs of one tag, their ends trimmed; tags: those of the text from `start` on."""
    out = []
    edges = np.flatnonzero(np.diff(tags, prepend=0, append=0))
    for a, b in zip((edges[:-1] + start).tolist(), (edges[1:] + start).tolist()):
        if tag := tags[a - start]:
            while b > a and not text[b - 1].isalnum():
                b -= 1
            while a < b and not (text[a].isalnum() or text[a] in "+("):
                a += 1
            if b > a and _plausible(text[a:b], ORDER[tag - 1]):
                out.append((a, b, ORDER[tag - 1]))
    return out


def scan_pii(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", sample_docs: int = 400, sample_windows: int = 5000, hidden: int = 16,
    train_size: int = 64, updates: int = 300, size: int = 128, overlap: int = 48, seed: int = 3,
) -> DataFrame:
    """(doc_id, n_email, n_ip, n_card, n_phone, n_added, base_sha256, spans): one row per row of docs.

    n_email to n_phone count the spans of the base patterns; the tagger adds spans that overlap none of them. Offsets are code
    points, ends exclusive. The tagger is learnt in numpy from at most sample_windows labelled windows of at most 1.5 *
    sample_docs documents; all documents and whole texts are scanned. NULL texts are empty and hold nothing; repeated
    rows are scanned each; an empty table gives no rows; other columns are not read. Scanning needs no shuffle.
    """
    tagger = fit(labelled_windows(docs, id_column, text_column, sample_docs, sample_windows, train_size, seed), hidden, train_size, updates, seed)
    shared = docs.sparkSession.sparkContext.broadcast(tagger)  # fixed size, about 60 KB
    kind = docs.schema[id_column].dataType.simpleString()

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches_of(batches, 512):
            texts = batch["text"].tolist()
            extra = tagged_spans(texts, shared.value, size, overlap) if shared.value else [[]] * len(texts)
            out = []
            for row_id, text, more in zip(batch["doc_id"], texts, extra):
                base = base_spans(text)
                added = uncovered(more, base)
                counts = [sum(k == name for _, _, k in base) for name in ORDER]
                out.append((row_id, *counts, len(added), digest(joined(base, ORDER)), joined(base + added, ORDER)))
            yield pd.DataFrame(out, columns=["doc_id", "n_email", "n_ip", "n_card", "n_phone", "n_added", "base_sha256", "spans"])

    rows = docs.select(F.col(id_column).alias("doc_id"), text_of(text_column).alias("text"))
    return rows.mapInPandas(
        scan, f"doc_id {kind}, n_email long, n_ip long, n_card long, n_phone long, n_added long, base_sha256 string, spans string"
    )
