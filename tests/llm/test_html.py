from postalith.llm import html
from postalith.llm.common import Scratch

SHELL = """<!doctype html><html><head><title>T</title><style>p{{}}</style></head><body><header><h1>Site</h1></header><nav><a href="/">Home</a></nav>
<div class="cookie-notice">We use cookies</div><script>var a = "</p>";</script><div id="sidebar"><p>Side</p></div>{}<form><p>Name</p></form>
<section class="comments"><article class="comment"><p>First!</p></article></section><footer>&copy; Us</footer></body></html>"""


def texts(spark, rows):
    pages = spark.createDataFrame([(*r, "clash") for r in rows], "page_id long, url string, html string, lines string")
    found = html.extract(pages, Scratch(spark, "t"))
    assert found.columns == ["page_id", "url", "text", "n_chars"]
    out = {}
    for r in found.collect():
        assert r["n_chars"] == len(r["text"])
        out[r["page_id"]] = r["text"]
    return out


def test_articles_stay_whole(spark):
    body = "<article><h1>Head &amp;amp; line</h1><p><b>One.<br><p>Two\n  &nbsp; words &#x1F600;</p><!-- x --><ul><li>a</li><li>b</li></ul></article>"
    got = texts(spark, [(1, "http://h/a/1", SHELL.format(body)), (2, "http://h/a/2", SHELL.format(body)), (3, "http://h/a/1", SHELL.format(body)), (3, "http://h/a/1", SHELL.format(body))])
    assert set(got.values()) == {"Head &amp; line\nOne.\nTwo words 😀\na\nb"}


def test_article_gold_texts(spark):
    body = (
        '<article><header><h2>By line</h2></header><h1 title="5" tall">Gold</h1><p data-x=a>b title="x>y">One</p><div class="share-price">Price 7</div><div class="search-results">Found</div>'
        '<section class="alert">Alarm!</section><div class="ad">Buy</div><aside>Aside</aside><p>E = <math><mi>m</mi></math></p><object><p>Plan</p></object><noscript>No script</noscript>'
        '<ul class="menu"><li>Menu</li></ul><form>Name</form><div id="comments"><p>First</p></div><p>End</p></article>'
    )
    want = "Gold\nb title=\"x>y\">One\nPrice 7\nFound\nAlarm!\nE = m\nPlan\nNo script\nEnd"
    assert texts(spark, [(1, "http://h/1", SHELL.format(body))]) == {1: want}


def test_the_documents_pages_give_their_articles(spark):
    import html as parser
    import re

    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    got = {r["page_id"]: r["text"] for r in html.extract(pages, Scratch(spark, "t")).collect()}
    for r in pages.collect():  # gold: these articles hold headings and paragraphs only, a paragraph start ends the one before
        inner = re.search(r"<article>(.*)</article>", r["html"] or "", re.S)
        blocks = re.split(r"</?(?:h1|p)>", inner[1]) if inner else []
        texts_ = [" ".join(parser.unescape(re.sub(r"<br>", " ", re.sub(r"</?b>", "", x))).split()) for x in blocks]
        assert got[r["page_id"]] == "\n".join(x for x in texts_ if x)


def test_pairing_decides_without_an_article(spark):
    page = lambda own, extra="": f"<body><div>Welcome to our site</div><div>Opening hours: nine to five</div>{''.join(f'<div>Fixed line {i}</div>' for i in range(20))}<p>{own}</p>{extra}<div>Call us</div></body>"
    rows = [(1, "http://h/a/1", page("Alpha")), (2, "http://h/a/2", page("Beta")), (3, "http://h/a/3", page("Gamma")), (4, "http://h/a/4", page("Gamma")), (5, "http://h/a/5", page("Gamma", "<p>More</p>"))]
    rows += [(6, "http://h/b/1", page("Delta")), (7, "http://alone/b/1", page("Epsilon"))]
    got = texts(spark, rows)
    alone = texts(spark, [(7, "http://alone/b/1", page("Epsilon"))])
    # with the pairing only a page's own lines stay, be the template larger than the text and neighbours copies or near copies
    assert [got[k] for k in (1, 2, 3, 4, 5, 6)] == ["Alpha", "Beta", "Gamma", "Gamma", "Gamma\nMore", "Delta"]
    assert got[7] == alone[7] and got[7].startswith("Welcome to our site\n") and "Epsilon" in got[7]


def test_without_an_article_shared_lines_go(spark):
    page = lambda own: SHELL.format(f"<div><p>Welcome to our site</p><p>{own}</p><p>Call us today</p></div>")
    got = texts(spark, [(1, "http://h/x/1", page("First story " * 9)), (2, "http://h/x/2", page("Second story " * 9)), (3, "http://other/x/3", page("Third story"))])
    assert got == {1: ("First story " * 9).strip(), 2: ("Second story " * 9).strip(), 3: "Welcome to our site\nThird story\nCall us today"}


def test_copies_without_an_article_stay(spark):
    page = SHELL.format("<div><p>One long story told twice</p></div>")
    assert set(texts(spark, [(1, "http://h/1", page), (2, "http://h/2", page)]).values()) == {"One long story told twice"}


def test_an_articles_template_lines_go_by_the_pairing(spark):
    page = lambda own, first="Share this story": SHELL.format(f"<article><p>{first}</p><h1>{own} head</h1><h2>Background</h2><p>{(own + ' told at length ') * 9}</p><p>Read our house rules</p><p>Write to the desk</p></article>")
    whole = lambda own: f"{own} head\nBackground\n{(own + ' told at length ') * 9}".strip()
    rows = [(i, f"http://h/a/{i}", page(own)) for i, own in enumerate(("Alpha", "Beta", "Gamma", "Delta", "Delta", "Epsilon", "Zeta", "Eta"))] + [(9, "http://alone/a/1", page("Alpha"))]
    rows += [(20 + i, f"http://g/a/{i}", page(own, first=f"Told by {own}")) for i, own in enumerate(("Alpha", "Beta", "Gamma", "Delta"))]
    rows += [(30 + i, f"http://s/a/{i}", page(own)) for i, own in enumerate(("Alpha", "Beta", "Gamma"))]
    got = texts(spark, rows)
    # headings among own lines stay, a copy among the neighbours tells nothing, a page alone stays whole
    assert [got[i] for i in range(8)] == [whole(own) for own in ("Alpha", "Beta", "Gamma", "Delta", "Delta", "Epsilon", "Zeta", "Eta")]
    assert got[9] == f"Share this story\n{whole('Alpha')}\nRead our house rules\nWrite to the desk"
    assert got[20] == "Told by Alpha\n" + whole("Alpha")
    assert got[30] == got[9]  # two neighbours may share a line by chance


def test_odd_pages(spark):
    rows = [(1, None, None), (2, "", ""), (3, "http://h/", "no markup at all"), (4, "http://h/", "<p>open <b>tags"), (5, ":::", "<script>only"), (None, "http://h/", "<p>null key</p>"), (6, "http://h/", "<p>" + "x " * 200_000)]
    got = texts(spark, rows)
    assert got == {1: "", 2: "", 3: "no markup at all", 4: "open tags", 5: "", None: "null key", 6: ("x " * 200_000).strip()}
    assert texts(spark, []) == {}


def test_common_is_a_longest_common_subsequence():
    import itertools
    import random

    rng = random.Random(0)
    for _ in range(60):
        a, b = rng.sample(range(9), 6), rng.sample(range(9), 6)
        best = max((len(c) for n in range(7) for c in itertools.combinations(a, n) if list(c) == [x for x in b if x in c]), default=0)
        found = [a[i] for i in html.common(a, b)]
        assert len(found) == best and found == [x for x in b if x in found]
