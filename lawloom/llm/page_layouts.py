"""The small labelled table that the block classifier learns from: page layouts with a mark per line.

`+` lines hold main text, `-` lines do not, `.` lines are markup alone. `{a-b}` stands for a to b words, `{links a-b}` for links in a row, `{items a-b}`
for list items that are links; the words are seeded.
"""

import math
import re

import numpy as np

LAYOUTS = [
    """- <html><head><title>{3-9}</title><style>p{margin:0}</style><script>var s = "<p>x</p>";</script></head><body>
- <nav><ul>{items 3-9}</ul></nav><div class="ad">{2-20}</div>
+ <article><h1>{3-14}</h1><p>{1-80}</p><p>{1-200}</p><p>{1-12}</p>
+ <p><b>{2-60}<br></p><p>All rights reserved.</p><p>{1-200}</p></article>
- <footer>&copy; {1-3} &middot; {2-10}</footer></body></html>""",
    """- <body><header><div class="logo"><a href="/">{1-3}</a></div><p>{2-12}</p></header><nav>{links 3-8}</nav>
. <main><article><header>
+ <h1>{3-12}</h1></header><p>{10-120}</p><h2>{1-6}</h2><p>{5-90}</p><ul><li>{2-15}</li><li>{2-15}</li></ul><p>{1-9}</p>
- <aside class="pull-right related"><h3>{2-4}</h3><ul>{items 2-5}</ul></aside>
+ <p>{4-150}</p><blockquote>{6-40}</blockquote><table><tr><td>{1-4}</td><td>{1-4}</td></tr></table>
- <footer class="entry-footer">{2-9} <a href="/t">{1-2}</a></footer></article></main>
- <section id="comments"><h3>{1-4}</h3><article class="comment"><p>{3-60}</p></article><article class="comment"><p>{1-30}</p></article></section>
- <footer><p>{4-25}</p>{links 2-6}</footer>""",
    """- <body><div id="top"><ul class="menu">{items 4-9}</ul></div><div class="cookie-notice"><p>{8-45}</p><button>{1-2}</button></div>
+ <div id="content"><h1>{2-10}</h1><p>{20-160}</p><p>{1-20}</p><p>{15-90} <a href="/x">{1-3}</a> {4-30}</p><h3>{1-7}</h3><p>{8-60}</p></div>
- <div id="sidebar"><h4>{1-3}</h4><p>{4-40}</p><ul>{items 3-8}</ul></div>
- <div id="footer"><p>{3-30}</p></div>""",
    """- <body><table><tr><td><a href="/a">{1-2}</a></td><td><a href="/b">{1-2}</a></td><td><a href="/c">{1-2}</a></td></tr></table>
+ <h1>{2-9}</h1><p>{25-140}</p><p>{20-120}</p><p>{6-30}</p><p>{18-100}</p>
- <p>{links 3-7}</p><p>{links 2-5}</p>
- <p><a href="/p">{1-3}</a> | <a href="/i">{1-3}</a></p>""",
    """- <div class="topbar">{links 2-5}</div><form action="/s"><label>{1-3}</label><input name="q"><select><option>{1-2}</option></select></form>
+ <div class="post"><h2 class="post-title">{2-10}</h2><div class="post-body"><p>{15-140}</p><p>{3-60}</p><pre>{3-30}</pre><p>{2-40}</p></div></div>
- <div class="share">{links 2-4}</div><div class="newsletter"><p>{6-30}</p><form><input></form></div>
- <div class="related-posts"><h3>{1-4}</h3><div><a href="/r">{3-9}</a><p>{5-30}</p></div><div><a href="/q">{3-9}</a><p>{5-30}</p></div></div>
- <div id="disqus_thread"><p>{2-60}</p><p>{2-50}</p></div>
- <p class="copyright">{3-15}</p>""",
    """- <div role="banner"><p>{1-8}</p></div><div role="navigation">{links 3-7}</div><div role="alert">{4-25}</div>
+ <div role="main"><h1>{3-11}</h1><p>{2-60}</p><p>{30-200}</p><dl><dt>{1-3}</dt><dd>{4-30}</dd></dl><figure><img src="x"><figcaption>{3-18}</figcaption></figure><p>{5-80}</p></div>
- <div role="complementary"><p>{5-50}</p><p>{5-50}</p></div><div role="contentinfo"><p>{3-20}</p></div>""",
    """- <form id="aspnet" method="post"><div class="navbar">{links 3-6}</div>
+ <main><h1>{2-8}</h1><p>{12-90}</p><p>{1-10}</p><ol><li>{3-25}</li><li>{3-25}</li><li>{1-8}</li></ol><p><a href="/d">{2-6}</a></p><p>{10-70}</p></main>
- <div class="widget"><p>{4-30}</p></div><div class="banner sponsored">{3-25}</div></form>""",
    """- <p><a href="/">{1-2}</a> &gt; <a href="/n">{1-2}</a></p><ul>{items 3-8}</ul>
+ <div><h1>{3-10}</h1></div><div><p>{30-150}</p><div>{20-110}</div><p>{10-70}</p><p>{2-9}</p><p>{25-90}</p></div>
- <div><h4>{1-3}</h4><ul>{items 3-9}</ul></div><div>{links 3-6}</div>""",
    """- <ul>{items 2-6}</ul><hr>
+ <h1>{2-8}</h1>{30-200}<hr>{15-90}<p>{20-140}<p>{3-25}<p>{12-100}
- <hr><a href="/i">{1-3}</a> <a href="/j">{1-3}</a>""",
    """- <div class="modal popup"><h2>{2-6}</h2><p>{6-30}</p></div><div class="breadcrumbs">{links 2-4}</div>
+ <article><h1>{2-9}</h1><p>{1-6}</p><p>{1-8}</p><p>{1-4}</p><h2>{1-3}</h2><p>{1-9}</p></article>
- <div class="pagination">{links 2-5}</div><div class="advert"><p>{3-40}</p></div><div class="comments"><ol><li>{2-70}</li><li>{1-40}</li></ol></div>""",
    """- <body><div>{2-25}</div><ul>{items 2-7}</ul><p>{3-40}</p>
+ <article><h1>{2-12}</h1><p>{1-150}</p><p>{1-10}</p><p><a href="/d">{2-5}</a></p><h2>{1-5}</h2><p>{2-90}</p><p>&copy; {1-20}</p><ul><li>{1-12}</li><li>{1-12} <a href="/l">{1-4}</a></li></ul></article>
- <p>{3-60}</p><div>{2-25} <a href="/m">{1-2}</a></div><div>&copy; 2024 {1-5}</div>""",
    """- <div>{links 3-8}</div><div><a href="/u">{1-3}</a></div>
+ <h1>{2-10}</h1><div>{1-5}</div><div>{30-140}</div><div>{2-14}</div><div>{12-120}</div><div>{8-90} <a href="/v">{1-4}</a></div>
- <div>{links 2-6}</div><div>Copyright {2-8}</div>""",
    """- <td>{links 2-6}</td>
+ <h2>{2-9}</h2><p>{15-160}</p><p>{1-8}</p><p>{10-80}</p>
- <h3>{1-3}</h3><ul>{items 3-8}</ul><h3>{1-3}</h3><ul>{items 3-8}</ul><p>&copy; {1-6}</p><p>{1-4}</p><p>{links 2-4}</p>""",
    """- <nav>{links 5-40}</nav><div class="notice">{20-120}</div><div>{links 10-40}</div>
+ <h1>{2-10}</h1><p>{20-150}</p><p>{1-14}</p><p>{20-90}</p><p>{1-6}</p>
- <div class="sidebar"><p>{20-120}</p><p>{1-9}</p><p>{15-90}</p></div>
+ <p>{20-120}</p>
- <div class="comment">{1-150}</div><div>{links 12-40}</div><footer>{20-80}</footer>""",
    """- <div>{links 12-40}</div><aside>{10-120}</aside><div class="sponsored">{10-100}</div>
+ <main><h1>{2-10}</h1><p>{2-140}</p>
- <div class="ad">{5-100}</div><div class="share">{links 3-20}</div><form><label>{1-12}</label><p>{1-40}</p></form>
+ <p>{1-90}</p><p>{1-12}</p></main>
- <div class="comments"><p>{10-150}</p><p>{1-80}</p></div><footer><p>{10-90}</p></footer>""",
]
_MARKED = re.compile(r"\{(?:(links|items) )?(\d+)-(\d+)\}")


def fill(layout: str, seed: int) -> tuple[str, list[tuple[int, bool | None]]]:
    """A page of a layout, and for each of its lines where it begins and whether its text is main text."""
    rng = np.random.default_rng(seed)

    def words(n: int) -> str:
        said = " ".join("".join(chr(97 + c) for c in rng.integers(0, 26, rng.integers(1, 9))) for _ in range(n))
        return said.capitalize() + "." * bool(n > 4 and rng.random() < 0.8)

    def put(m: re.Match) -> str:
        low, high = int(m[2]), int(m[3])
        n = min(high, round(math.exp(rng.uniform(math.log(low), math.log(high + 0.49)))))
        if not m[1]:
            return words(n)
        link = lambda: f'<a href="/{rng.integers(99)}">{words(int(rng.integers(1, 4)))}</a>'
        return " ".join(f"<li>{link()}</li>" if m[1] == "items" else link() for _ in range(n))

    page, lines = "", []
    for line in layout.split("\n"):
        lines.append((len(page), {"+": True, "-": False}.get(line[0])))
        page += _MARKED.sub(put, line[2:])
    return page, lines
