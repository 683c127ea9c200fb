import itertools
import random

import pytest

from tidegauge.llm.html_extract import extract_pages, main_text, minimum_cut

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head>
<body class="has-sidebar"><header><h1>Site</h1><a href=/>Home</a></header>
<nav><ul><li><a href=/a>A</a><li><a href=/b>B</a></ul></nav><div class="cookie-notice">We use cookies &amp; more</div>
<div class="ad">Buy this very good thing now, it is the best thing that was ever made by anyone.</div>
<article><header><h2>The   head</h2></header><p><b>First &lt;para&gt;<br>goes on.<p>S.</p><ul><li>one</li><li>two</ul>
<form><p>Your name, which we need for a reason that is long enough to look like text</p></form>
<div id="comments"><p>I liked this, and so I write a long comment that looks like the text itself.</p></div></article>
<aside><p>An aside that is long enough to look like the text of the page, but it is not.</p></aside>
<footer>&copy; all rights</footer></body></html>"""


def test_article_without_the_rest():
    assert main_text(PAGE) == "The head\nFirst <para> goes on.\nS.\none\ntwo"


ARTICLE = "<h2>Title</h2>" + "".join(
    f"<p>Paragraph {i} tells a long story about rivers, tides and gauges, in plain words that go on.</p>" for i in range(5)
)
MENU = "<ul><li><a href=/>Home</a><li><a href=/b>News of the day</a><li><a href=/c>About us and others</a></ul>"
WRAPPERS = [
    '<form id="aspnetForm"><input type="hidden" name="state">%s</form>',
    '<form action="/go"><input type="text" name="q">%s</form>',
    '<div class="side-by-side">%s</div>',
    '<div class="page header-fixed">%s</div>',
    '<div id="page" class="sticky-nav">%s</div>',
    '<div class="content share-enabled">%s</div>',
    '<div class="sidebar-closed menu-open">%s</div>',
]


@pytest.mark.parametrize("wrapper", WRAPPERS)
def test_names_and_tags_around_the_page_lose_no_article(wrapper):
    text = main_text(ARTICLE)
    assert len(text) > 400 and text.startswith("Title")
    assert main_text(f"<body>{wrapper % ARTICLE}</body>") == text
    assert main_text(f"<body>{wrapper % (MENU + ARTICLE)}</body>") == text
    assert main_text(f"<body>{wrapper % (MENU + '<main>' + ARTICLE + '</main>')}<footer>{'All rights reserved. ' * 40}</footer></body>") == text


def test_marked_parts_of_a_page_still_go():
    side = "<p>" + "A note beside the text, which goes on for a while and then some more. " * 6 + "</p>"
    for part in (
        f'<div class="sidebar">{side}</div>',
        f"<aside>{side}</aside>",
        f'<div id="comments">{side * 3}</div>',
        f"<form><label>Your name, please, and what you think of this</label><input name=a><textarea></textarea><button>Send</button></form>",
    ):
        assert main_text(f"<body><article>{ARTICLE}</article>{part}</body>") == main_text(ARTICLE)


def test_a_page_of_one_line():
    assert main_text("just one line") == "just one line"
    assert main_text("<html><body><b>One</b> &amp; only</body></html>") == "One & only"
    assert main_text('<a href="/">Home</a>') == ""


def test_short_block_follows_its_neighbours():
    text = "This is a long paragraph of the text, with many words that say one thing and another. " * 3
    page = f"<div><p>{text}</p><p>Ok.</p><p>{text}</p></div><ul><li><a href=1>More</a><li><a href=2>Less</a></ul>"
    assert main_text(page) == "\n".join([text.strip(), "Ok.", text.strip()])


def test_cut_is_minimal():
    rng = random.Random(1)
    for _ in range(200):
        n = rng.randint(1, 7)
        costs = [(rng.choice([0, rng.random() * 3]), rng.choice([0, rng.random() * 3])) for _ in range(n)]
        ties = [(a, b, rng.random()) for a, b in itertools.combinations(range(n), 2) if rng.random() < 0.5]

        def cost(kept):
            own = sum(c[1] if k else c[0] for k, c in zip(kept, costs))
            return own + sum(w for a, b, w in ties if kept[a] != kept[b])

        best = min(cost(k) for k in itertools.product([False, True], repeat=n))
        assert abs(cost(minimum_cut(costs, ties)) - best) < 1e-6


def test_broken_pages_do_not_crash():
    rng = random.Random(2)
    for _ in range(300):
        page = "".join(rng.choice(["<", ">", "<p", "</div>", "<a href='", '"', "<!--", "x ", "&am", "<script>"]) for _ in range(30))
        main_text(page)
    deep = "<div>" * 3000 + "text" + "</div>" * 3000
    assert main_text(deep) in ("", "text")


def test_table_of_pages(spark):
    rows = [(1, "u", PAGE, "z"), (1, "u", PAGE, "z"), (2, None, None, "z"), (None, "v", "", "z"), (3, "w", "<p>" + "word " * 60_000, "z")]
    schema = "page_id long, url string, html string, text string"
    got = extract_pages(spark.createDataFrame(rows, schema)).collect()
    assert [r["text"] for r in got if r["page_id"] == 1] == [main_text(PAGE)] * 2
    assert {(r["page_id"], r["url"]): r["n_chars"] for r in got} == {
        (1, "u"): len(main_text(PAGE)), (2, None): 0, (None, "v"): 0, (3, "w"): 60_000 * 5 - 1
    }
    assert extract_pages(spark.createDataFrame([], schema)).collect() == []
