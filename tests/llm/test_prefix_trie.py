import hashlib
import random
import zlib
from collections import defaultdict

from lawloom.llm import prefix_trie
from tests.llm.helpers import no_rows, rows_of

SCHEMA = "conv_id long, turn long, role string, text string, name string, depth int"


def table(spark, rows):
    return spark.createDataFrame([(*r, "n", 1) for r in rows], SCHEMA)


def expected(rows, group=100, heads=6):
    def name(role, text):
        return hashlib.sha256(f"{len(role)}:{role}{text}".encode()).digest()

    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append((turn is not None, turn or 0, name(role or "", text or ""), role or "", text or ""))
    own = {c: [t[3:] for t in sorted(ts)] for c, ts in own.items()}
    whole = {}
    for c, ts in own.items():
        h = zlib.crc32(str(c).encode()) % heads
        lead = own.get(c - (abs(c) % group if c >= 0 else -(abs(c) % group)), [])
        whole[c] = lead[:h] + ts[h:]
    nodes = defaultdict(list)
    for c, ts in whole.items():
        for d in range(len(ts) + 1):
            nodes[tuple(ts[:d])].append(c)
    children = defaultdict(list)
    for p in nodes:
        if p:
            children[p[:-1]].append(p)

    def totals(p):
        leaves, saved = (0 if children[p] else 1), ((len(nodes[p]) - 1) * len(p[-1][1]) if p else 0)
        for q in children[p]:
            more = totals(q)
            leaves, saved = leaves + more[0], saved + more[1]
        return leaves, saved

    out = []
    for p, members in nodes.items():
        ends = ",".join(str(c) for c in sorted(members) if len(whole[c]) == len(p))
        out.append((min(members), len(p), min(nodes[p[:-1]]) if p else None, len(members), len(children[p]), *totals(p), hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def found(df):
    return sorted((tuple(r[c] for c in COLUMNS) for r in rows_of(df)), key=str)


def test_trie_matches_brute_force(spark):
    rng = random.Random(4)
    rows = []
    for c in [*range(-3, 140), *range(200, 230), 350, 10**12]:
        for t in range(rng.choice([1, 2, 3, 5, 9, 17])):
            rows.append((c, t, rng.choice(["user", "assistant"]), rng.choice(["a", "bb", "ünï \U0001f600"])))
    for options in ({}, {"group": 10, "heads": 3}, {"group": 7, "heads": 1}):
        assert found(prefix_trie.prefix_trie(table(spark, rows), **options)) == expected(rows, **options)


def test_awkward_rows(spark):
    rows = [
        (1, None, "user", "first"), (1, 0, None, None), (1, 0, "", ""), (2, 5, "user", None), (2, 5, "user", None), (3, 1, "user", "x" * 200_000), (None, 1, "user", "lost"),
        (100, 0, "a", ":b"), (101, 0, "a:", "b"), (4, -2, "system", "\x00 \\ ,"), (200, 0, "user", "short"), *((201 + i, t, "user", "same") for i in range(30) for t in range(3)),
    ]
    assert found(prefix_trie.prefix_trie(table(spark, rows))) == expected(rows)


def test_small_and_empty_tables(spark):
    assert prefix_trie.prefix_trie(no_rows(table(spark, [(1, 0, "user", "a")]))).count() == 0
    for rows in ([(100, 0, "user", "a")], [(7, 0, "user", "a")], [(105, 0, "user", "a")], [(None, 0, "user", "a")]):
        assert found(prefix_trie.prefix_trie(table(spark, rows))) == (expected(rows) if rows[0][0] is not None else [])


def test_many_ends_of_one_node(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "_CHUNK", 7)
    rows = [(c, t, "user", str(t)) for c in range(500) for t in range(2)]
    assert found(prefix_trie.prefix_trie(table(spark, rows), heads=1)) == expected(rows, heads=1)
