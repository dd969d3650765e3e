import fnmatch
import hashlib
import random
import re

from pyspark.sql import Row
from pyspark.sql import functions as F

from lawloom.llm import chat, queries
from lawloom.llm.url_filter import Automaton, Globs, Rule, judge_urls, split_url
from tests.llm.helpers import no_rows, rows_of


def test_automaton_fits_like_globs():
    rng = random.Random(3)
    make = lambda n: "".join(rng.choice("ab*?c/") for _ in range(n))
    patterns = [make(rng.randrange(9)) for _ in range(60)] + ["*" * 3, "", "a" * 70, "é*"]
    texts = ["".join(rng.choice("abc/é") for _ in range(rng.randrange(9))) for _ in range(300)] + ["a" * 70, ""]
    got = Automaton(patterns).matches(texts)
    for i, t in enumerate(texts):
        for j, p in enumerate(patterns):
            assert got[i, j] == fnmatch.fnmatchcase(t, p), (t, p)


def judged(url, rules, blocks):
    host, path, query = split_url(url)
    best = max((r for r in rules if ("." + host).endswith("." + r.host) and path.startswith(r.path)), key=lambda r: len(r.name), default=None)
    glob = next((g for g in blocks if fnmatch.fnmatchcase("." + host + path + query, g)), None)
    return host, path, best.name if best else None, best.verdict if best else "block" if glob else "allow"


def test_urls(spark):
    urls = [
        None, "", "no scheme", "http://Example.COM/en/1?q#f", "https://www.example.com/en/", "x://net/es/", "x://a.net/es/?", "x://a.net?/es/", "x://anet/es/1", "http://m.casino.org/x",
        "http://a.org/b#casino", "http://a.org?casino", "http://é.com/", "http://com", "http://a.b://c.com/", "http://ads-x.net/fr", "http://a.net/fr/" + "x" * 5000, "http://a.net/fr/",
    ]
    rows = [(i, u, "host", "rule") for i, u in enumerate(urls + urls[:3])] + [(None, urls[3], "h", "r")]
    df = spark.createDataFrame(rows, "page_id long, url string, host string, rule string")
    got = rows_of(judge_urls(df, queries.URL_RULES, queries.URL_GLOBS))
    want = [(i, *judged(u, queries.URL_RULES, queries.URL_GLOBS.block)) for i, u, *_ in rows]
    assert sorted(((r["page_id"], r["host"], r["path"], r["rule"], r["verdict"]) for r in got), key=str) == sorted(want, key=str)
    assert judge_urls(no_rows(df), [Rule("com", "/", "block")], Globs(())).count() == 0


TEXTS = [None, "", "plain", "\\### Assistant: </turn> ok", "\\e\\h\\l\\c <b> #1: a\n</turn>\n### user: x", "é\U0001f600" * 3, "\\", "\\\\l", "x" * 50_000]


def test_formatting_is_reversible(spark):
    rng = random.Random(5)
    convs = {c: [(rng.choice(["user", "assistant", "system", "a:b", None]), rng.choice(TEXTS)) for _ in range(rng.randrange(1, 9))] for c in range(60)}
    convs[60] = [("user", "q"), ("assistant", "a")]
    convs[61] = [("system", None), ("user", ""), ("assistant", "\\")]
    convs[62] = [("human", "keeps its name"), ("gpt", "too")]
    convs[63] = [("system", "s"), ("user", "u"), ("assistant", "a"), ("user", "v")]
    rows = [(c, i, r, t, "clash") for c, turns in convs.items() for i, (r, t) in enumerate(turns)]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, layout string")
    formatted = chat.format_chats(queries.chat_records(turns), "conv_id", "record")
    back = formatted.select("*", chat.read_turns(F.col("formatted")).alias("turns"), chat.masked_text(F.col("formatted"), F.col("loss_spans")).alias("loss"))
    got = {r["conv_id"]: r for r in rows_of(back)}
    assert len(got) == len(convs)
    for c, said in convs.items():
        want = [{"role": r or "", "text": t or ""} for r, t in said]
        assert got[c]["turns"] == want
        assert got[c]["loss"] == "".join(t["text"] for t in want if t["role"] == "assistant")
        assert got[c]["formatted"].count(chat.END) == len(said)
    assert {got[i]["layout"] for i in (60, 61, 62, 63)} == {"prompt", "instruction", "messages", "conversations"}


def test_layouts_by_fingerprint(spark):
    records = [
        Row(id=1, rec=Row(prompt="p", completion=None, instruction=None, output=None, input=None, messages=None, extra=None)),
        Row(id=2, rec=Row(prompt=None, completion=None, instruction="i", output="o", input="in", messages=None, extra=None)),
        Row(id=3, rec=Row(prompt=None, completion=None, instruction=None, output=None, input=None, messages=[Row(role="user", content="hi")], extra=None)),
        Row(id=4, rec=Row(prompt="p", completion="c", instruction=None, output=None, input=None, messages=None, extra="odd")),
        Row(id=5, rec=Row(prompt=None, completion=None, instruction=None, output=None, input=None, messages=[], extra=None)),
        Row(id=6, rec=None),
    ]
    schema = "id long, rec struct<prompt:string,completion:string,instruction:string,output:string,input:string,messages:array<struct<role:string,content:string>>,extra:string>"
    df = spark.createDataFrame(records, schema)
    got = {r["id"]: r for r in rows_of(chat.format_chats(df, "id", "rec"))}
    assert [got[i]["layout"] for i in range(1, 7)] == ["prompt", "instruction", "messages", None, "messages", None]
    assert got[2]["formatted"] == "### user: i</turn>\n### user: in</turn>\n### assistant: o</turn>\n"
    assert got[2]["formatted"][slice(*(lambda s: (s["start"], s["start"] + s["length"]))(got[2]["loss_spans"][0]))] == "o"
    assert got[4]["formatted"] is None and got[5]["formatted"] == "" and got[6]["formatted"] is None
    assert got[3]["fingerprint"] == hashlib.sha256("messages\nmessages[].content\nmessages[].role".encode()).hexdigest()
    assert chat.format_chats(no_rows(df), "id", "rec").count() == 0
    assert re.fullmatch("[0-9a-f]{64}", got[4]["fingerprint"])


def test_awkward_turns(spark):
    rows = [
        (1, 1, "assistant", "b", 0), (1, None, "user", "a", 1), (1, 1, "assistant", "b", 2), (None, 0, "user", "x", 3), (None, 1, "assistant", None, 4),
        (2, 0, None, None, 5), (3, 0, "user", "t" * 40_000, 6), (3, 0, "assistant", "", 7),
    ]
    turns = spark.createDataFrame(rows, "conv_id long, turn int, role string, text string, record int")
    formatted = chat.format_chats(queries.chat_records(turns), "conv_id", "record")
    got = {r["conv_id"]: [(t["role"], t["text"]) for t in r["turns"]] for r in rows_of(formatted.select("conv_id", chat.read_turns(F.col("formatted")).alias("turns")))}
    assert got == {
        1: [("user", "a"), ("assistant", "b"), ("assistant", "b")], None: [("user", "x"), ("assistant", "")], 2: [("", "")],
        3: [("assistant", ""), ("user", "t" * 40_000)],
    }
    assert chat.format_chats(queries.chat_records(no_rows(turns)), "conv_id", "record").count() == 0
