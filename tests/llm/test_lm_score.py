import math
from collections import Counter

import pytest
from pyspark.sql import functions as F

from lawloom.llm.lm_score import score_texts
from tests.llm.helpers import awkward, no_rows, prose, rows_of


def tokens(text):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return [w.decode() for w in lower.encode().split()] + ["</end>"]


def model(texts, order, strength):
    """Interpolated probabilities by recursion over suffixes: what the automaton must give."""
    grams = Counter()
    for text in texts:
        w = ["<start>", *tokens(text)]
        for k in range(1, order + 1):
            grams.update(tuple(w[i : i + k]) for i in range(len(w) - k + 1))
    total = sum(c for g, c in grams.items() if len(g) == 1 and g != ("<start>",))
    types = sum(len(g) == 1 and g != ("<start>",) for g in grams)

    def p(gram):
        if len(gram) == 1:
            return (grams[gram] + 0.1) / (total + 0.1 * (types + 1))
        return (grams[gram] + strength * p(gram[1:])) / (grams[gram[:-1]] + strength)

    def score(text):
        w = ["<start>", *tokens(text)]
        ends = range(1, len(w))
        return sum(math.log10(p(tuple(w[max(0, i - order + 1) : i + 1]))) for i in ends), sum(math.log10(p((w[i],))) for i in ends)

    return score, total, grams


@pytest.mark.parametrize("order,options", [(1, {}), (2, {"block_tokens": 50, "shard_grams": 200}), (3, {"block_tokens": 900}), (4, {})])
def test_automaton_gives_the_recursive_model(spark, order, options):
    docs = awkward(spark, [(20 + i, prose(i, 5 + 37 * i), "en", "s") for i in range(12)])
    rows = rows_of(docs)
    out = lambda r: r["doc_id"] is None or r["doc_id"] % 3 == 0
    score, total, grams = model([r["text"] for r in rows if not out(r)], order, 4.0)
    got = rows_of(score_texts(docs, F.col("doc_id") % 3 == 0, order=order, **options))
    key = lambda r: (str(r["doc_id"]), r["n_tokens"])
    want = sorted(({"doc_id": r["doc_id"], "n_tokens": len(tokens(r["text"])), "r": r} for r in rows), key=key)
    assert len(got) == len(rows)
    for g, w in zip(sorted(got, key=key), want):
        full, base = score(w["r"]["text"])
        assert (g["doc_id"], g["n_tokens"], g["held_out"], g["train_tokens"]) == (w["doc_id"], w["n_tokens"], out(w["r"]), total)
        assert g["n_known"] == sum(grams[(t,)] > 0 for t in tokens(w["r"]["text"]))
        assert g["score"] == pytest.approx(full, rel=1e-9) and g["base_score"] == pytest.approx(base, rel=1e-9)


def test_held_out_texts_and_empty_tables(spark):
    frame = spark.createDataFrame([(i, " ".join(["one two three four five six"] * 5 + [prose(i, 3)])) for i in range(60)], "doc_id long, text string")
    sums = score_texts(frame, F.col("doc_id") % 5 == 0).where("held_out").agg(F.sum("score"), F.sum("base_score")).first()
    assert sums[0] > sums[1]
    assert score_texts(no_rows(frame), F.lit(True)).count() == 0
    assert score_texts(frame, F.lit(True)).agg(F.max("train_tokens"), F.max("n_known")).first() == (0, 0)
