import re

from lawloom.llm.decontaminate import benchmark_hits, drop_contaminated, words_of
from tests.llm.helpers import awkward, no_rows, prose, rows_of


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def expected(text, items, window=10):
    own, hit, found = words(text), set(), set()
    for item, said in items:
        w = words(said)
        n = min(window, len(w))
        for i in range(len(w) - n + 1 if n else 0):
            for j in range(len(own) - n + 1):
                if own[j : j + n] == w[i : i + n]:
                    hit |= set(range(j, j + n))
                    found.add("" if item is None else str(item))
    return len(own), len(hit), sorted(found)


def test_words():
    for text in ["Ab-c ÄÖ 1,2\x00z y {q}~", "", prose(3, 50)]:
        assert [w.decode() for w in words_of(text)] == words(text)


def test_hits_match_brute_force(spark):
    passage = prose(100, 36)
    items = [(1, passage), (2, prose(101, 12)), (3, "river house"), (4, None), (5, ""), (None, "tall TREES under"), (7, passage), (8, prose(1, 40)), (9, "x")]
    more = [
        (30, f"{prose(31, 20)} {passage.upper()} {prose(32, 5)}", "en", "s"), (31, " ".join(passage.split()[3:14]), "en", "s"),
        (32, " ".join(passage.split()[3:12]), "en", "s"), (33, f"{passage} {passage}", "en", "s"), (34, prose(101, 12).replace(" ", "--"), "en", "s"),
    ]
    docs = awkward(spark, more)
    table = spark.createDataFrame([(*i, "n") for i in items], "item_id long, text string, key string")
    got = sorted(((r["doc_id"], r["n_words"], r["n_hit"], r["item_ids"]) for r in rows_of(benchmark_hits(docs, table))), key=str)
    assert got == sorted(((r["doc_id"], *expected(r["text"], items)) for r in rows_of(docs)), key=str)
    clean = {r["doc_id"] for r in rows_of(docs) if not expected(r["text"], items)[1]}
    out = drop_contaminated(docs, table)
    assert out.columns == docs.columns and {r["doc_id"] for r in rows_of(out)} == clean


def test_empty_tables(spark):
    docs, items = awkward(spark), spark.createDataFrame([(1, prose(1, 20))], "item_id long, text string")
    assert benchmark_hits(no_rows(docs), items).count() == 0
    assert benchmark_hits(docs, no_rows(items)).where("n_hit > 0").count() == 0
    assert drop_contaminated(docs, no_rows(items)).count() == docs.count()
