from collections import defaultdict

from pyspark.sql import functions as F

from lawloom.llm.mixing import leaf_budgets, mix, mixed_documents
from tests.llm.helpers import awkward, no_rows, prose, rows_of

WEIGHTS = {"domain": {"a": 3, "b": 1}, "lang": {"en": 2}, "source": {"x": 1}}


def fill(budget, children):
    """Budgets of (weight, capacity) children, by repeated sharing of what full ones leave."""
    given, left = [0.0] * len(children), float(budget)
    while left > 1e-9 and (open_ := [i for i, (w, c) in enumerate(children) if given[i] < c - 1e-9]):
        total, spent = sum(children[i][0] for i in open_), 0.0
        for i in open_:
            add = min(left * children[i][0] / total, children[i][1] - given[i])
            given[i] += add
            spent += add
        left -= spent
    return given


def test_budgets_follow_the_tree(spark):
    leaves = [("a", "en", "x", 100), ("a", "en", "y", 10), ("a", "de", "x", 30), ("b", "en", "x", 1000), ("b", "de", "x", 5), ("c", "en", "z", 50)]
    df = spark.createDataFrame(leaves, "domain string, lang string, source string, tokens long")
    for total in (7, 120, 600, 0.5, 10_000):
        got = {(r["domain"], r["lang"], r["source"]): r["budget"] for r in rows_of(leaf_budgets(df, total, WEIGHTS, 1, 2))}
        all_tokens = sum(t for *_, t in leaves)
        budget = min(total * all_tokens if isinstance(total, float) else total, 2 * all_tokens)
        weight = lambda level, n: WEIGHTS[level].get(n, 1)
        want, doms = {}, sorted({x[0] for x in leaves})
        cap = lambda *p: sum(2 * x[3] for x in leaves if x[: len(p)] == p)
        for d, bd in zip(doms, fill(budget, [(weight("domain", d), cap(d)) for d in doms])):
            langs = sorted({x[1] for x in leaves if x[0] == d})
            for la, bl in zip(langs, fill(bd, [(weight("lang", la), cap(d, la)) for la in langs])):
                srcs = sorted({x[2] for x in leaves if x[:2] == (d, la)})
                for s, bs in zip(srcs, fill(bl, [(weight("source", s), cap(d, la, s)) for s in srcs])):
                    want[d, la, s] = bs
        assert all(want[k] - 4 <= got[k] <= want[k] + 1e-6 for k in want), (total, got, want)


def test_prefixes_and_epochs(spark):
    more = [(100 + i, prose(i, 1 + i % 30), "en", "hot") for i in range(300)]
    docs = awkward(spark, more)
    options = {"domain": F.when(F.col("source") == "hot", "a").otherwise("b"), "total": 0.7, "weights": WEIGHTS, "max_epochs": 3, "seed": 4}
    got = rows_of(mix(docs, **options))
    taken, budgets = defaultdict(int), {}
    for r in got:
        leaf = (r["domain"], r["lang"], r["source"])
        assert 0 < r["take_tokens"] <= r["n_tokens"]
        taken[leaf] += r["take_tokens"] * (r["copies"] if r["take_tokens"] == r["n_tokens"] else 1)
        budgets[leaf] = r["leaf_budget"]
    # rows that are equal in all count once; each other leaf gives its budget exactly
    assert all(taken[leaf] >= budgets[leaf] for leaf in budgets)
    assert taken["a", "en", "hot"] == budgets["a", "en", "hot"]
    assert len([r for r in got if r["take_tokens"] < r["n_tokens"]]) <= len(budgets)
    assert sorted(map(str, got)) == sorted(map(str, rows_of(mix(docs, **options))))
    assert sorted(map(str, got)) != sorted(map(str, rows_of(mix(docs, **(options | {"seed": 5})))))
    out = mixed_documents(docs.withColumn("epoch", F.lit("mine")), **options)
    assert out.columns == [*docs.columns, "epoch", "epoch_", "take_tokens"] and out.count() == len(got)
    assert mix(no_rows(docs), **options).count() == 0 and mixed_documents(no_rows(docs), **options).count() == 0
