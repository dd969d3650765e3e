import random
from collections import defaultdict

from lawloom.llm.jaccard_join import drop_near_copies, near_copies, runs_for
from tests.llm.helpers import awkward, no_rows, prose, rows_of


def changed(text, seed, n):
    rng, words = random.Random(seed), text.split()
    for _ in range(n):
        words[rng.randrange(len(words))] = f"new{rng.randrange(10**6)}"
    return " ".join(words)


def shingles(text):
    w = (text or "").lower().split()
    n = min(5, len(w))
    return {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if w else set()


def expected(rows):
    """Links of each row, and its class, by comparing all with all."""
    sets = [shingles(r["text"]) for r in rows]
    links, top = [0] * len(rows), list(range(len(rows)))

    def find(x):
        return x if top[x] == x else find(top[x])

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and both >= 0.8 * (len(sets[i]) + len(sets[j]) - both) - 1e-9:
                links[i] += 1
                links[j] += 1
                top[find(i)] = find(j)
    classes = defaultdict(list)
    for i, r in enumerate(rows):
        classes[find(i)].append(r["doc_id"])
    least = {k: min((i for i in ids if i is not None), default=None) for k, ids in classes.items()}
    return sorted(((r["doc_id"], least[find(i)], links[i], len(classes[find(i)])) for i, r in enumerate(rows)), key=str)


def test_links_and_classes_match_all_pairs(spark):
    base, shared, more = prose(50, 120), prose(60, 30), []
    more += [(100 + i, changed(base, i, i % 5), "en", "s") for i in range(60)]
    more += [(200 + i, f"{shared} {prose(200 + i, 40)}", "en", "s") for i in range(60)]
    more += [(300 + i, changed(prose(300 + i // 2, 80), i, i % 2), "en", "s") for i in range(40)]
    docs = awkward(spark, more)
    want = expected(rows_of(docs))
    for options in ({}, {"bucket": 8}, {"bucket": 8, "depth": 1, "shard_bytes": 20_000}):
        got = rows_of(near_copies(docs, **options))
        assert sorted(((r["doc_id"], r["class_id"], r["n_links"], r["class_size"]) for r in got), key=str) == want, options
    assert any(r[2] > 20 for r in want)
    out = rows_of(drop_near_copies(docs))
    classes = {r[:2][1] if r[3] > 1 else ("alone", r[0], k) for k, r in enumerate(want)}
    assert len(out) == len(classes) and out[0].keys() == rows_of(docs)[0].keys()


def test_recall_and_empty_tables(spark):
    assert runs_for(0.9, 1) < runs_for(0.99, 1) < runs_for(0.99, 3)
    docs = awkward(spark)
    assert near_copies(no_rows(docs)).count() == drop_near_copies(no_rows(docs)).count() == 0
