import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np

from lawloom.llm import resample
from tests.llm.helpers import awkward, no_rows, prose, rows_of

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def features(text, longest):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return words, [" ".join(words[i : i + n]) for n in range(1, longest + 1) for i in range(len(words) - n + 1)]


def expected(docs, items, longest, buckets, percent, least):
    bucket = lambda f: zlib.crc32(f.encode()) % buckets
    s = Counter(bucket(f) for _, t in docs for f in features(t, longest)[1])
    t = Counter(bucket(f) for x in items for f in features(x, longest)[1])
    S, T = sum(s.values()), sum(t.values())
    out = []
    for i, text in docs:
        words, own = features(text, longest)
        gain = [math.floor(1000 * math.log((t[b] + 1) * (S + buckets) / ((s[b] + 1) * (T + buckets)))) for b in map(bucket, own)]
        weight = sum(gain) // len(gain) if gain else 0
        h = int(hashlib.sha256(f"2024:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        out.append([i, len(own), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), len(words)])
    may = sorted((r for r in out if r[4] >= least), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    ranks = {n: (k + 1 if k < len(may) * percent // 100 else None) for k, n in enumerate(map(id, may))}
    return sorted(((*r[:4], ranks.get(id(r))) for r in out), key=str)


def test_scores_and_ranks_match_brute_force(spark):
    docs = awkward(spark, [(20 + i, prose(i % 30, 5 + i), "en", "s") for i in range(60)])
    items = [prose(3, 30), None, "", prose(200, 50)]
    target = spark.createDataFrame([(i, t, 1) for i, t in enumerate(items)], "item_id long, text string, score long")
    plain = [(r["doc_id"], r["text"]) for r in rows_of(docs)]
    for longest, buckets, percent, least in ((1, 10000, 10, 20), (3, 100, 35, 1), (2, 70000, 100, 0)):
        got = rows_of(resample.importance_sample(docs, target, longest=longest, buckets=buckets, percent=percent, least_words=least))
        got = sorted(((r["doc_id"], r["n_features"], r["weight"], r["score"], r["rank"]) for r in got), key=str)
        assert got == expected(plain, items, longest, buckets, percent, least)


def test_many_rows_of_one_score_get_all_ranks(spark):
    rows = spark.range(0, 5000, 1, 7).selectExpr("(id * 7919) % 5000 as doc_id", "5L as score")
    got = {r["doc_id"]: r["rank"] for r in rows_of(resample.ranked(rows, 4000))}
    assert got == {i: i + 1 if i < 4000 else None for i in range(5000)}


def test_windows_are_offset_pairs():
    text = "The HOUSE, stands\x00near 2 old-trees"
    split, sums = resample.splitter(), resample.WordSums(limit=2)
    offsets, crcs, n = resample.windows(text, 3, split, sums)
    words, own = features(text, 3)
    assert n == len(words) == 7 and len(own) == len(offsets) == 7 + 6 + 5
    assert [zlib.crc32(f.encode()) for f in own] == crcs.tolist()
    assert [" ".join(WORD.findall(resample.lowered(text)[a:b])) for a, b in offsets.tolist()] == own
    assert resample.windows("", 2, split, sums)[0].shape == (0, 2)


def test_target_words_draw_documents(spark):
    rng = np.random.default_rng(5)
    rows = [(i, " ".join(("law" if i < 200 else "tree") + str(rng.integers(30)) for _ in range(40))) for i in range(1000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    target = spark.createDataFrame([(0, " ".join(f"law{i % 30}" for i in range(400)))], "item_id long, text string")
    drawn = resample.drawn_documents(docs, target)
    assert drawn.columns == docs.columns
    ids = [r["doc_id"] for r in rows_of(drawn)]
    assert len(ids) == 100 and sum(i < 200 for i in ids) > 60


def test_empty_tables(spark):
    docs, target = awkward(spark), spark.createDataFrame([(1, prose(1, 20))], "item_id long, text string")
    assert resample.importance_sample(no_rows(docs), target).count() == 0
    assert resample.importance_sample(docs, no_rows(target), least_words=1, percent=50).where("rank is not null").count() > 0
    assert resample.drawn_documents(docs, target, percent=0).count() == 0
