import html
import re

import pyarrow.parquet as pq
import pytest

from drawloom.llm.html_text import extract, main_text


def plain(source):
    """The article of the synthetic pages, by their template."""
    inner = re.search(r"<article>(.*?)(?:</article>|\Z)", source, re.S)[1]
    blocks = re.split(r"</?(?:p|h1|div|ul|li)\b[^>]*>", inner)
    lines = (" ".join(html.unescape(re.sub(r"<[^>]*>", "", b.replace("<br>", " "))).split()) for b in blocks)
    return "\n\n".join(x for x in lines if x)


@pytest.mark.parametrize("sf", ["sf0.01", "sf0.1"])
def test_all_synthetic_pages(sf):
    t = pq.read_table(f"/root/testdata/{sf}/pages.parquet").to_pylist()
    bad = [r["page_id"] for r in t if main_text(r["html"]) != plain(r["html"])]
    assert not bad, (len(bad), bad[:5])


WORDS = "The council met on Monday to discuss the new bridge over the river. "
PAGES = [
    (f"<body><div id=top-menu><a href=x>Home</a> <a href=y>News</a></div><div class='content'><h2>Title &amp; more</h2><p>{WORDS * 4}</p><p>{WORDS * 3}<a href=z>link</a></p></div><div class=sidebar><p>{WORDS * 2}</div><div class='comments'><p>{WORDS * 5}</p></div></body>",
     ["Title & more", (WORDS * 4).strip(), (WORDS * 3) + "link"]),
    (f"<article><header><h1>Head</h1></header><p>{WORDS}<p>Short.<ul><li>one<li>two <b>bold</b></ul><aside>{WORDS}</aside><form><p>{WORDS}</form></article><footer>foot</footer>", ["Head", WORDS.strip(), "Short.", "one", "two bold"]),
    (f"<div>{WORDS * 3}<br>next\n\t line</div><script>if (a < b) {{ '<p>' }}</script><!-- <p>no</p> --><div role=contentinfo>{WORDS}</div>", [WORDS * 3 + "next line"]),
    ("", []), ("no tags &lt;here&gt; 1 < 2", ["no tags <here> 1 < 2"]), ("<p>open <b>bold", ["open bold"]), ("<html><head><title>x</title></head><body></body>", []), ("<a", ["<a"]),
    (f"<body><p>{WORDS}</p><p style='display: none'>{WORDS}</p><p>é&nbsp;&#233;&hellip;</p></body>", [WORDS.strip(), "é é…"]),
    ("<div class=notice>only text</div>", ["only text"]),
]


@pytest.mark.parametrize("page,want", PAGES)
def test_hand_made_pages(page, want):
    assert main_text(page) == "\n\n".join(" ".join(w.split()) for w in want)


def test_deep_broken_and_null_pages(spark):
    deep = "<div>" * 5000 + WORDS + "</p></i>" + "<b x='\"" * 200
    df = spark.createDataFrame([(1, "u", deep), (None, None, None), (2, "v", PAGES[0][0]), (2, "v", PAGES[0][0])], "page_id long, url string, html string").selectExpr("*", "1 as id", "2 as text")
    got = extract(df).collect()
    assert len(got) == 4 and all(r["n_chars"] == len(r["text"]) for r in got) and got[0]["text"].startswith("The council")
    assert extract(df.limit(0)).count() == 0


def test_line_breaks_and_names():
    assert main_text("<p>line one<br>line two</p>") == "line one line two"
    assert main_text("<p>a <span class=related>really</span> good one</p>") == "a really good one"
    assert main_text("<div><p class='notice-of-war'>The war</p><p>other</p></div>") == "The war\n\nother"
    # the name of what holds almost all text is wrong; that of a smaller container is not
    assert main_text(f"<div class=sidebar-layout><p>{WORDS * 9}</p></div><p>x</p>").startswith((WORDS * 9).strip())
    assert main_text(f"<div><p>{WORDS * 3}</p><div class=cookie-notice><p>{WORDS}</p></div></div>") == (WORDS * 3).strip()


def test_articles_shorter_than_their_comments_and_names_within_them():
    comments = "".join(f"<div class='comment'><p>Reader {i} says: {WORDS}</p></div>" for i in range(8))
    for holder in ("div class=comments", "section id=comments", "ul class=comment-list"):
        tag = holder.split()[0]
        assert main_text(f"<div class=story><p>Two sentences only.</p><p>This is one.</p></div><{holder}>{comments}</{tag}>") == "Two sentences only.\n\nThis is one."
    assert main_text(f"<article><p>{WORDS * 9}</p></article><article class='comment'><p>Reader: {WORDS}</p></article><p class=comment>so so</p>") == (WORDS * 9).strip()
    parts = "<section class='related-work'><h2>Related work</h2><p>Others did it.</p></section><section id='social-history'><p>A history.</p></section>"
    assert main_text(f"<article><p>{WORDS * 9}</p>{parts}<div class='related-posts'><p>{WORDS}</p></div></article>") == f"{(WORDS * 9).strip()}\n\nRelated work\n\nOthers did it.\n\nA history."
    around = f"<div><h1>Head</h1><p>lead</p><div class=body><p>{WORDS * 9}</p><p>{WORDS * 9}</p></div><p>last note</p><p><a href=x>more of it</a></p></div>"
    assert main_text(around) == "\n\n".join(["Head", "lead", (WORDS * 9).strip(), (WORDS * 9).strip(), "last note"])
    assert main_text(f"<p>{WORDS}</p><div hidden=''><p>{WORDS}</p></div>") == WORDS.strip()


@pytest.mark.parametrize("source", [
    f"<div {'a' * 64_000} class=1>x", f"<div a{' ' * 64_000}b class=1>x", f"<div {'hidden-' * 20_000} class=1>x",
    "<div>" * 100_000 + "x", '<a href="' * 50_000, "<a b='\">" * 50_000, "<p><b>" * 50_000 + "<h1>x" * 20_000, "<!" * 100_000, "<ul><li>x" * 30_000, "<p>" * 100_000, "</div>" * 100_000,
])
def test_time_grows_with_length_only(source):
    import time

    began = time.process_time()
    main_text(source)
    assert time.process_time() - began < 4


def test_density_sums_equal_brute_force():
    """Random trees: the parts found are those by densities computed for each node from scratch."""
    import math
    import random

    r = random.Random(5)
    for _ in range(200):
        made = iter(range(10_000))
        word = lambda: "w%dx" % next(made) * r.choice([1, 1, 3, 9])

        def tree(depth):
            kids = [word() if depth == 0 or r.random() < 0.4 else tree(depth - 1) for _ in range(r.randint(0, 4))]
            return (r.choice(["div", "section", "span", "a"]) if depth else r.choice(["p", "span", "a"]), kids)

        body = ("body", [tree(3) for _ in range(r.randint(1, 4))])
        render = lambda x: x + " " if isinstance(x, str) else f"<{x[0]}>{''.join(map(render, x[1]))}</{x[0]}>"

        def words(x, link=False):
            return [(x, link)] if isinstance(x, str) else [w for k in x[1] for w in words(k, link or x[0] == "a")]

        def nodes(x):
            return [] if isinstance(x, str) else [x] + [y for k in x[1] for y in nodes(k)]

        def walk(x, up, link):
            if not isinstance(x, str):
                link = link or x[0] == "a"
                found.append((x, up, link))
                for k in x[1]:
                    walk(k, x, link)

        found = []
        walk(body, None, False)
        every = words(body)
        ratio = sum(len(w) for w, a in every if a) / max(sum(len(w) for w, _ in every), 1)

        def dense(x, link):
            ws = words(x, link and x[0] != "a")
            c, lc = sum(len(w) for w, _ in ws), sum(len(w) for w, a in ws if a)
            t, lt = max(len(nodes(x)) - 1, 1), max(sum(n[0] == "a" for n in nodes(x)[1:]), 1)
            if not c:
                return 0.0
            base = math.log(c / max(c - lc, 1) * lc + ratio * c + math.e)
            # without any link on the page the logarithm has base 1: plain characters per tag
            return c / t * (math.log(max(c / max(lc, 1) * t / lt, 1)) / math.log(base) if base > 1.0001 else 1)

        density = {id(x): dense(x, a) for x, _, a in found}
        blocks = {"div", "section", "p", "body"}
        holds = [x for x, _, _ in found if any(not isinstance(k, str) and k[0] in blocks for k in x[1])] or [body]
        best = max(holds, key=lambda x: sum(density[id(k)] for k in x[1] if not isinstance(k, str)))
        above = {id(x): up for x, up, _ in found}
        path = [best]
        while path[-1] is not body:
            path.append(above[id(path[-1])])
        least = min(density[id(x)] for x in path)
        parts = [best] + [k for below, x in zip(path, path[1:]) for k in x[1] if not isinstance(k, str) and k is not below and k[0] in blocks and words(k) and density[id(k)] >= least]
        assert set(main_text(render(body)).split()) == {w for x in parts for w, _ in words(x)}
