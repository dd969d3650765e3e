import html
import random
import re

import numpy as np

from lawloom.llm import main_text
from lawloom.llm.page_layouts import LAYOUTS
from tests.llm.helpers import prose, rows_of

TREE = main_text.learnt_tree()


def text_of(page):
    return main_text.extracted([page], TREE)[0][0]


def test_tree_knows_layouts_and_fresh_words():
    for seed in (5, 6):
        x, y = main_text.labelled_blocks(LAYOUTS, 24, seed)
        assert (TREE.holds(x) == y).mean() > 0.995
    held = []
    for n, layout in list(enumerate(LAYOUTS))[::2]:
        tree = main_text.learnt_tree(LAYOUTS[:n] + LAYOUTS[n + 1 :])
        x, y = main_text.labelled_blocks([layout], 12, 7)
        held.append((tree.holds(x) == y).mean())
    assert np.median(held) > 0.95


def test_tree_is_a_plain_walk():
    x, _ = main_text.labelled_blocks(LAYOUTS[:3], 3, 8)
    for row, got in zip(x, TREE.holds(x)):
        node = 0
        while TREE.feature[node] >= 0:
            node = TREE.left[node] if row[TREE.feature[node]] <= TREE.threshold[node] else TREE.right[node]
        assert (TREE.share[node] >= 0.5) == got


def test_known_paragraphs_come_back():
    rng = random.Random(3)
    for n in range(40):
        paragraphs = [prose(n * 50 + k, rng.choice([1, 2, 5, 30, 90])) + rng.choice(["", ".", ' & "x" < y > ©']) for k in range(rng.randint(1, 12))]
        said = "".join(f"<p class=x>{html.escape(p)}{rng.choice(['</p>', '<br></p>', ''])}" for p in paragraphs[1:])
        article = f"<h1>{html.escape(paragraphs[0])}</h1>{said}"
        article = article.replace("river", "<b>riv</b>er").replace("house ", "house<!-- <p>no</p> -->\n\t")
        page = (
            f"<!DOCTYPE html><html><head><title>t</title><script>if (a < b) '<p>no</p>'</script></head><body><nav><ul><li><a href=/a>Home</a><li><a href='/b>c'>News</a></ul></nav>"
            f"<header><p>{prose(1, 9)}</p></header><div class='cookie-bar notice'>{prose(2, 30)}</div><article>{article}<div class=\"ad\">{prose(4, 40)}</div><form><label>Mail</label></form></article>"
            f"<aside>{prose(5, 50)}</aside><div id='comments'><div class='comment'><p>{prose(6, 60)}</p></div></div><footer>&copy; {prose(7, 12)}</footer></body></html>"
        )
        assert text_of(page).split("\n\n") == [" ".join(p.split()) for p in paragraphs]


def test_awkward_markup():
    long = "word " * 60
    cases = {
        "": "", "plain words only, without any markup at all in them.": "plain words only, without any markup at all in them.",
        f"<article><p>{long}": long.strip(), f"<article><p>{long}<p unclosed": long.strip(), f"<article><p>{long}&am": f"{long}&am",
        f"<article><p>{long}&amp &lt;b&gt; &#233;&nbsp;x</p></article></div></p></article>": f"{long}& <b> é x",
        f"<ARTICLE><P>{long}</P><SCRIPT>x</script ><p>a < b > c</p></ARTICLE>": f"{long.strip()}\n\na < b > c",
        f"<article><p hidden>{long}</p><p>{long}</p><noscript><p>no</p></noscript><svg><text>no</text></svg></article>": long.strip(),
        f"<article><style>p</article></style><p>{long}</p><!-- never closed <p>{long}</p></article>": long.strip(),
        f"<article><table><tr><td>one<td>two<tr><td>three</table><ul><li>four<li>five</ul><p>{long}</article>": f"one\n\ntwo\n\nthree\n\nfour\n\nfive\n\n{long.strip()}",
        f"<form><div class=menu><a href=/a>x</a></div><h1>Title of it</h1><p>{long}</p><p>{long}</p></form>": f"Title of it\n\n{long.strip()}\n\n{long.strip()}",
        f"<form><div id=content><p>{long}</p><p>x</p></div><p>Search here</p></form><p>{long}{long}</p>": f"{long.strip()}\n\nx",
        "<article>" + "<div>" * 3000 + f"<p>{long}</p>" + "</div>" * 2999 + "</article><footer>end</footer>": long.strip(),
    }
    for page, expected in cases.items():
        assert text_of(page) == expected, page[:80]


def test_rows_of_awkward_pages(spark):
    pages = [(1, "u", "<article><h1>Title</h1><p>Text.</p></article>"), (2, None, None), (None, "u", ""), (3, "u", "<p>x</p>" * 3), (3, "u", "<p>x</p>" * 3), (4, "v", "<article><p>" + "a b " * 200_000)]
    table = spark.createDataFrame([(*p, 7, "t") for p in pages], "page_id long, url string, html string, n_chars int, text string")
    got = rows_of(main_text.main_texts(table))
    assert sorted((str(r["page_id"]), str(r["url"]), r["text"]) for r in got) == sorted((str(i), str(u), text_of(h or "")) for i, u, h in pages)
    assert all(r["n_chars"] == len(r["text"]) for r in got) and max(r["n_chars"] for r in got) == 799_999
    assert main_text.main_texts(table.where("false")).count() == 0


def test_given_pages(spark):
    """The pages at hand name their article; what it holds by a plain cut is what the classifier keeps."""
    for r in rows_of(main_text.main_texts(spark.read.parquet("/root/testdata/sf0.01/pages.parquet")).join(spark.read.parquet("/root/testdata/sf0.01/pages.parquet").select("page_id", "html"), "page_id")):
        article = re.search(r"<article>(.*?)(?:</article>|\Z)", r["html"], re.S)[1].replace("<br>", " ")
        blocks = [" ".join(html.unescape(re.sub("<[^>]*>", "", p)).split()) for p in re.split("</?(?:p|h1)>", article)]
        assert r["text"] == "\n\n".join(b for b in blocks if b)
