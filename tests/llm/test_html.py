import random
from collections import defaultdict

import pytest

from riskflow.llm.html import blocks, main_text

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style><script>var a="</p>";</script></head><body>
<header><a href="/">Home</a></header><nav><ul><li><a href="/x">X</a></ul></nav><div class="cookie-notice">We use cookies</div><!-- <p>no</p> -->
<article><h1>Title {0}</h1><p>First <b>bold</b> &amp; more&nbsp;text {0}.<br>Line<p>Second &lt;tag&gt;
 {0}<ul><li>one<li>two</ul><table><tr><td>c<td>d</table><aside>Related</aside><form><p>Mail <input></form><div id="comments"><p>Reader says</p></div></article>
<div class="sidebar">Side</div><footer>&copy; Site</footer></body></html>"""
TEXT = "Title {0}\nFirst bold & more text {0}. Line\nSecond <tag> {0}\none\ntwo\nc d"


def pages(spark, rows):
    return spark.createDataFrame([(*r, "a", "b", 1) for r in rows], "page_id long, url string, html string, host string, blocks string, id long")


def texts(spark, rows, **k):
    return {r["page_id"]: r["text"] for r in main_text(pages(spark, rows), **k).collect()}


def test_article_only(spark):
    assert texts(spark, [(1, "http://h/1", PAGE.format("one"))]) == {1: TEXT.format("one")}


@pytest.mark.parametrize(
    "page,text",
    [
        ("plain words", ["plain words"]),
        ("<p>a<p>b", ["a", "b"]),
        ("<P CLASS=x>a</P >b<script>never", ["a", "b"]),
        ("a <!-- never closed", ["a"]),
        ("<div>a<b>b</div>c</b>", ["ab", "c"]),
        ("<td>1</td><td>2</td>", ["1 2"]),
        ("a &lt; b &#233; &unknown; <", ["a < b é &unknown; <"]),
        ("</p></div></nope>x", ["x"]),
        ("<p title='a>b'>c", ["c"]),
        ("<body class='has-sidebar menu'><div class='with-sidebar'>a</div><div class='my-sidebar'>b</div><div class='adult'>c</div>", ["a", "c"]),
        ("<head><title>t</title><body>x", ["x"]),
        ("<textarea><p>no</textarea>y<svg><text>n</text></svg>", ["y"]),
    ],
)
def test_broken_markup(page, text):
    assert [b.text for b in blocks(page) if not b.dropped] == text


def test_template_blocks_go_slots_stay(spark):
    """Without an article the host's template tells what repeats, however short the story; a lone page of another host
    keeps the same words."""
    page = "<body><div>Welcome to the site</div><div>Story {0} about {1}</div><div>All rights kept</div></body>"
    rows = [(i, "http://same/" + str(i), page.format(i, "x" * i)) for i in range(10)] + [(100, "http://other/", page.format(100, "y"))]
    found = texts(spark, rows)
    assert all(found[i] == f"Story {i} about {'x' * i}".strip() for i in range(10))
    assert found[100] == "Welcome to the site\nStory 100 about y\nAll rights kept"


def test_page_types(spark):
    """A menu on 12 pages, another on 8; each is template where it stands. A line that some stories share is none."""
    a = "<body><div>Home</div><div>Shop</div><div>Story {0} of goods</div><div>Terms of {1}</div></body>"
    b = "<body><div>Start</div><div>Blog</div><div>Tale {0} of people</div><div>Terms of {1}</div></body>"
    rows = [(i, f"http://h/{i}", (a if i < 12 else b).format("shared" if i in (1, 2, 3, 4, 5, 6) else i, "trade")) for i in range(20)]
    found = texts(spark, [(i, u, p.replace("</div></body>", f"</div><p>end {i}</p></body>")) for i, u, p in rows])
    for i in range(20):
        name = "shared" if i in (1, 2, 3, 4, 5, 6) else i
        assert found[i] == (f"Story {name} of goods\nend {i}" if i < 12 else f"Tale {name} of people\nend {i}")


def test_links_that_are_text(spark):
    page = "<body><ul><li><a href=/>Home</a><li><a href=/b>Blog</a></ul><p>Words</p><p><a href=/s>One link is a paragraph</a></p><p>More</p></body>"
    assert texts(spark, [(1, "http://h/", page)]) == {1: "Words\nOne link is a paragraph\nMore"}
    bare = "<body><div><a href=/>Home</a></div><div><a href=/b>Blog</a></div><p>Words</p></body>"
    assert texts(spark, [(1, "http://h/", bare)]) == {1: "Words"}


def test_names_inside_an_article(spark):
    page = """<article><header class="post-header"><h1>Headline</h1></header><div class="social-history">Trade in the north</div><div id="notice-of-poll">Vote</div>
    <div class="ad-hoc">Made for it</div><div class="social-links">Follow</div><div class="cookie-notice">Accept</div><div class="ad-slot-2">Buy</div>
    <div id="comments-section">Reader</div><div class="share-buttons">Share</div><footer>Filed under</footer></article>"""
    assert texts(spark, [(1, "http://h/", page)]) == {1: "Headline\nTrade in the north\nVote\nMade for it"}


def test_a_notice_in_every_article_goes_a_shared_passage_stays(spark):
    page = "<body><article><h1>T{0}</h1><p>Own text {0}</p>{1}<p>Read our terms first</p><p>Closing {0}</p></article></body>"
    rows = [(i, f"http://h/{i}", page.format(i, "<p>A passage that some share</p>" if i % 2 else "")) for i in range(12)]
    found = texts(spark, rows)
    assert all(found[i] == f"T{i}\nOwn text {i}\n" + ("A passage that some share\n" if i % 2 else "") + f"Closing {i}" for i in range(12))


def plain_template(pages, min_pages=5, share=0.9):
    """{(page, block number)} that the template of one host holds, by dictionaries."""
    found = [[b for b in blocks(p) if not b.dropped] for p in pages]
    whole = {tuple(b.token for b in f): f for f in found}
    vectors = defaultdict(dict)
    for key, f in whole.items():
        for t in key:
            vectors[t][key] = key.count(t)
    groups = defaultdict(list)
    for t, v in vectors.items():
        if len(v) >= min_pages:
            groups[frozenset(v.items())].append(t)
    valid = {}
    for v, tokens in groups.items():
        orders = {tuple(sorted(tokens, key=key.index)) for key, _ in v}
        if len(orders) == 1:
            valid[v] = tokens
    span = lambda key, tokens: (min(key.index(t) for t in tokens), max(len(key) - 1 - key[::-1].index(t) for t in tokens))
    general, places = set(), defaultdict(set)
    for v, tokens in valid.items():
        parents = set()
        for key, _ in v:
            lo, hi = span(key, tokens)
            around = [(b - a, w) for w, other in valid.items() if key in dict(w) for a, b in [span(key, other)] if a < lo and b > hi]
            parents.add(min(around, key=lambda x: x[0])[1] if around else None)
        of = len(parents.pop() or whole) if len(parents) == 1 else len(whole)
        general |= set(tokens) if len(v) >= share * of else set()
        for key, _ in v:
            for b in whole[key]:
                if b.token in tokens:
                    places[b.place].add((key, b.token))
    narrow = set()
    for place, all_held in places.items():
        held = {(key, t) for key, t in all_held if t not in general}
        if len({key for key, _ in held}) >= share * sum(any(b.place == place for b in f) for f in whole.values()):
            narrow |= {(t, place) for _, t in held}
    return {(i, k) for i, f in enumerate(found) for k, b in enumerate(f) if b.token in general or (b.token, b.place) in narrow}


@pytest.mark.parametrize("seed", range(4))
def test_templates_equal_a_plain_deduction(spark, seed):
    """Random hosts: shared lines, page types, lines in changing order, repeated lines, copies of pages."""
    rng = random.Random(seed)
    pool = [f"line {i}" for i in range(8)]
    pages_ = []
    for i in range(40):
        kind = rng.random() < 0.6
        rows = ["top", "left" if kind else "right", *rng.sample(pool, rng.randint(0, 3)), *["again"] * rng.choice([1, 1, 2]), *[f"own {i} {k}" for k in range(rng.randint(0, 2))], "a" if kind else "b", "end"]
        if rng.random() < 0.1:
            rows[0], rows[-1] = rows[-1], rows[0]
        pages_.append("<body>" + "".join(f"<div>{r}</div>" for r in rows) + "</body>")
    pages_ += pages_[:3]
    rows = [(i, "http://h/", p) for i, p in enumerate(pages_)]
    dropped = {r["page_id"]: r for r in main_text(pages(spark, rows)).collect()}
    held = plain_template(pages_)
    assert held
    for i, p in enumerate(pages_):
        whole = [b.text for b in blocks(p)]
        left = [t for k, t in enumerate(whole) if (i, k) not in held]
        assert dropped[i]["text"] == "\n".join(left or whole) and dropped[i]["template_blocks"] == (len(whole) - len(left) if left else 0)


def test_one_article_under_many_addresses_is_kept(spark):
    page = "<body><div>menu {0}</div><article><p>The same long article text everywhere</p></article></body>"
    assert set(texts(spark, [(i, f"http://h/{i}", page.format(i)) for i in range(10)]).values()) == {"The same long article text everywhere"}


def test_odd_rows(spark):
    rows = [(1, None, None), (2, "x", ""), (3, "http://h", " \n "), (4, None, "<p>" * 30_000 + "deep"), (5, "http://h", "word " * 100_000), (6, "u", "<" * 20_000), (None, "u", "a"), (7, "u", "b"), (7, "u", "b")]
    out = main_text(pages(spark, rows)).collect()
    found = {r["page_id"]: r["text"] for r in out}
    assert len(out) == len(rows) and found[1] == found[2] == found[3] == "" and found[4] == "deep" and len(found[5]) == 499_999 and found[None] == "a"
    assert main_text(pages(spark, [])).collect() == []
