import random

from pyspark.sql import functions as F

from lawloom.llm.language import OTHER, identify, keep_identified, page_evidence
from tests.llm.helpers import no_rows, rows_of

WORDS = {
    "en": "the of and to in is that it was for on are with as this have from by not but what all were when".split(),
    "de": "der die und in den von zu das mit sich des auf für ist im dem nicht ein eine als auch es an werden".split(),
    "fr": "de la le et les des en un du une que est pour qui dans par plus pas au sur ne se ce il sont".split(),
}


def text(language, seed, n):
    rng = random.Random(seed)
    return " ".join(rng.choice(WORDS[language]) for _ in range(n))


def corpus(spark):
    rows = [(i, text(lang, i, 5 + i % 40), lang, f"h{i % 3}.{lang}", i) for i, lang in enumerate(["en", "de", "fr"] * 60)]
    rows += [
        (900, None, "en", "h0.en", 0), (901, "", None, None, 0), (902, "12 34 !!", "en", "h0.en", 0), (903, "漢字仮名交文字列一二三四五六七八九十百千万億兆京垓" * 3, "en", "x", 0),
        (904, "es", None, "h1.de", 0), (905, text("de", 9, 30), "en", "h0.en", 0), (905, text("de", 9, 30), "en", "h0.en", 0), (None, text("fr", 3, 20_000), None, None, 0),
    ]
    return spark.createDataFrame([(*r, 1.0, "x") for r in rows], "doc_id long, text string, lang string, source string, n_grams long, posterior double, language string")


def test_evidence_is_fused(spark):
    docs = corpus(spark)
    train = docs.where("doc_id < 900 and doc_id % 2 = 0").select(F.col("lang").alias("label"), "text")
    got = {}
    for r in rows_of(identify(docs, ["en", "de", "fr"], declared=F.col("lang"), host=F.col("source"), labelled=train)):
        got.setdefault(r["doc_id"], []).append(r)
    held = [(i, lang) for i, lang in enumerate(["en", "de", "fr"] * 60) if i % 2]
    assert sum(got[i][0]["text_language"] == lang for i, lang in held) >= 0.97 * len(held)
    assert all(got[i][0]["language"] == lang for i, lang in held)
    assert got[905][0]["language"] == "de" and len(got[905]) == 2  # a long text outweighs what is declared
    assert got[904][0]["language"] == "de"  # a short one goes by its host
    assert got[903][0]["language"] == OTHER
    assert [got[i][0]["accepted"] for i in (900, 901, 902, 903, 905, None)] == [False, False, False, False, True, True]
    kept = keep_identified(docs, ["en", "de", "fr"], declared=F.col("lang"), host=F.col("source"), labelled=train)
    assert kept.columns == docs.columns and kept.count() == docs.count() - 4


def test_sample_of_labels_and_empty_table(spark):
    docs = corpus(spark)
    got = rows_of(identify(docs, ["en", "de", "fr"], per_language=30))
    assert sum(r["text_language"] == ["en", "de", "fr"][r["doc_id"] % 3] for r in got if (r["doc_id"] or 999) < 180) >= 170
    assert identify(no_rows(docs), ["en", "de"]).count() == 0
    assert keep_identified(no_rows(docs), ["en"]).count() == 0


def test_page_evidence(spark):
    rows = [(1, "https://WWW.Example.de:80/x?y", '<!doctype html><HTML class="a" lang=\'DE-at\'><script>let a="<b>"</script><p>Hallo <b>Welt</b><!-- no --></p>'), (2, None, None)]
    a, b = rows_of(page_evidence(spark.createDataFrame(rows, "page_id long, url string, html string")).orderBy("page_id"))
    assert (a["host"], a["declared"], a["text"].split()) == ("www.example.de", "de", ["Hallo", "Welt"])
    assert (b["host"], b["declared"], b["text"]) == ("", "", "")


def test_pages_of_hosts_that_share_suffixes(spark):
    """Pages without letters have the priors alone; these are worked out here from the hosts' page counts."""
    page = lambda url, lang, said, seed: (url, f"<html{f' lang={said}' if said else ''}><p>{text(lang, seed, 80) if lang else '12'}</p>")
    held = {"a.x.de": "de" * 4, "b.x.de": "", "c.x.de": "en", "solo": "dede", "d.x.com": "enenen", "e.x.com": "", "one.org": "dedede"}
    rows = [page(f"http://{host}/{i}", langs[2 * i : 2 * i + 2], langs[2 * i : 2 * i + 2] if i % 2 else "", i) for host, langs in held.items() for i in range(len(langs) // 2)]
    rows += [page(f"https://{host}/", "", "", 0) for host in held]
    pages = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "page_id long, url string, html string")
    train = spark.createDataFrame([(lang, text(lang, 500 + i, 100)) for lang in ("en", "de") for i in range(20)], "label string, text string")
    got = rows_of(identify(page_evidence(pages), ["en", "de"], "page_id", declared=F.col("declared"), host=F.col("host"), labelled=train))
    got = {r["host"]: r for r in got if r["n_grams"] == 0}
    count = lambda texts: [sum(t.count(lang) for t in texts) for lang in ("en", "de")] + [0]
    share = lambda own, prior, strength: [(o + strength * p) / (sum(own) + strength) for o, p in zip(own, prior)]
    one = [n + 1 for n in count(held.values())]
    everywhere = [n / sum(one) for n in one]
    unsaid = share(count([t[i : i + 2] for t in held.values() for i in range(0, len(t), 4)]), everywhere, 20)
    for host, langs in held.items():
        suffix = host.rsplit(".", 1)[-1]
        others = count([t for h, t in held.items() if h != host and h.rsplit(".", 1)[-1] == suffix])
        prior = share(count([langs]), share(others, everywhere, 20), 5)
        odds = [h * u / e * w for h, u, e, w in zip(prior, unsaid, everywhere, (1, 1, 1e-3))]
        assert abs(got[host]["posterior"] - max(odds) / sum(odds)) < 1e-4, host
        assert got[host]["language"] == ["en", "de"][odds[1] > odds[0]] and not got[host]["accepted"]
