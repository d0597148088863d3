import time

from tollstream.llm.extract import main_text, query, with_main_text
from tollstream.llm.shared import table

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head><body>
<header>Site name here</header><nav><ul><li><a href="/a">Home, page</a></li></ul></nav><!-- hidden, text -->
<div class="cookie-notice"><p>We use cookies, as all sites do, for you.</p></div>
<article><h1>A headline &amp; more</h1><p><b>First  sentence,
with breaks.<br><p>Second &lt;block&gt;, rather longer than the first one.</p><ul><li>point one</li><li>point two</ul></article>
<div id="comments"><p>A reader writes, at length, what they think of all this.</p></div>
<aside>Related, things</aside><form><p>Your name, please</p></form><footer>&copy; all rights, reserved.</footer></body></html>"""


def test_article_only():
    assert main_text(PAGE) == ("A headline & more First sentence, with breaks. Second <block>, rather longer than the "
                               "first one. point one point two")


def test_page_without_article_element():
    body = "".join(f"<p>This is paragraph {k}, and it has a fair length, as texts do.</p>" for k in range(8))
    links = "".join(f'<li><a href="/{k}">Link {k}</a></li>' for k in range(12))
    html = f"<html><body><div><ul>{links}</ul></div><div class='story'>{body}</div><div>x</div></body></html>"
    text = main_text(html)
    assert text.startswith("This is paragraph 0") and "as texts do." in text and "Link" not in text


def test_odd_pages():
    assert main_text(None) == "" and main_text("") == "" and main_text("   ") == ""
    assert main_text("plain  text") == "plain text"
    assert main_text("<p>a<p>b<script>x</script") == "a b"
    assert main_text("<main><p>x &amp; y <b>z</b>w</p></main>") == "x & y zw"
    assert main_text("<!-- never closed") == "" and main_text('<a href="x') == '<a href="x'


STORY = "".join(f"<p>This is paragraph {k}, and it has a fair length, as texts do.</p>" for k in range(6))
WANT = " ".join(f"This is paragraph {k}, and it has a fair length, as texts do." for k in range(6))


def test_wrappers_named_like_parts_beside_the_content():
    side = "<div class='sidebar'><p>More stories, from the side of it all.</p></div>"
    related = "<div class='related'><article><p>Another story, teased here, in brief.</p></article></div>"
    for name in ("layout has-sidebar", "main no-sidebar", "post tag-news", "search-results"):
        for inner in (f"<article>{STORY}</article>", f"<main>{STORY}</main>", f"<div>{STORY}</div>"):
            page = f"<html><body><nav>Home, page</nav><div class='{name}'>{inner}{side}</div></body></html>"
            assert main_text(page) == WANT, (name, inner)
        page = f"<body><div class='{name}'><div id='page-with-menu'>{related}<article>{STORY}</article>{side}</div></div></body>"
        assert main_text(page) == WANT
        assert main_text(f"<body><article><div class='{name}'>{STORY}</div></article>{side}</body>") == WANT
    assert main_text(f"<body><form id='f' action='/'><div><article>{STORY}</article>{side}</div></form></body>") == WANT
    assert main_text(f"<body><form action='/'><div>{STORY}</div>{side}</form></body>") == WANT


def test_parts_beside_the_content_stay_out():
    comments = "<div id='comments'>" + "<article><p>A reader writes, at length, what they think.</p></article>" * 9 + "</div>"
    assert main_text(f"<body><article>{STORY}</article>{comments}<form><p>Your name, please.</p></form></body>") == WANT
    assert main_text(f"<body><div>{STORY}</div>{comments.replace('article', 'div')}</body>") == WANT
    few = "<div id='comments'><article><p>A reader writes, at length.</p></article></div>"
    assert main_text(f"<body><div>{STORY}</div>{few}</body>") == WANT
    assert main_text(f"<body><div class='has-menu'><article>{STORY}</article>{comments}</div></body>") == WANT


def test_nested_wrappers_are_linear():
    start = time.time()
    main_text("<div class='ad'>" * 30000 + "text, here." + "<div class='ad'>x</div>" * 30000)
    assert time.time() - start < 30


def test_long_pages_are_linear():
    start = time.time()
    for page in ("<div>a b c." * 50000, "<p>" + "abc, def. " * 500000, '<a href="' * 200000, "<!" * 200000,
                 "<b>x</i>" * 20000, "<li>a" * 50000):
        main_text(page)
    assert time.time() - start < 60


def test_table_and_odd_rows(spark):
    import re
    from html import unescape

    pages = {r["page_id"]: r["html"] for r in table(spark, "/root/testdata/sf0.001", "pages").collect()}
    for r in query(spark, "/root/testdata/sf0.001").collect():
        article = re.search(r"<article>(.*?)</article>", pages[r["page_id"]], re.S)[1]
        want = " ".join(unescape(re.sub(r"<[^>]+>", " ", re.sub(r"</?b>", "", article))).split())
        assert r["text"] == want and r["n_chars"] == len(want)
    odd = spark.createDataFrame([(1, None, "u"), (1, "", "u"), (None, "<p>a</p>", "u"), (1, None, "u")],
                                "page_id long, html string, value string")
    assert [r["text"] for r in with_main_text(odd).collect()] == ["", "", "a", ""]
    assert with_main_text(odd.limit(0)).count() == 0


def test_link_lists_and_named_lines_inside_an_article():
    links = "".join(f"<li><a href='/{k}'>Read more stories, part {k}</a></li>" for k in range(5))
    points = "<ul><li>point one</li><li>point two</li></ul>"
    for extra in (f"<ul>{links}</ul>", "<p class='x'><a href='/b'>Buy now</a></p>", "<div class='share'>Share this on X</div>",
                  "<div class='social'>Share this on X</div>", "<div class='adbox'>Cheap shoes, today only.</div>",
                  "<ul class='thread'><li>A reader writes, at length, what they think.</li></ul>"):
        assert main_text(f"<body><article>{STORY}{extra}</article></body>") == WANT, extra
        assert main_text(f"<body><article>{extra}{STORY}{points}</article></body>") == f"{WANT} point one point two", extra
    linked = "<p>This one, <a href='/x'>with a link, a long one</a>, is a paragraph.</p>"
    assert main_text(f"<body><article><h1><a href='/h'>The headline</a></h1>{STORY}{linked}</article></body>") == (
        f"The headline {WANT} This one, with a link, a long one, is a paragraph.")


def test_content_with_a_class_word_stays():
    long = "This section, as the others, has a fair length, and commas, as texts do, so that it counts."
    for name in ("legal", "social-impact", "search", "tag", "widget"):
        assert main_text(f"<body><article>{STORY}<p class='{name}'>{long}</p>{STORY}</article></body>") == f"{WANT} {long} {WANT}", name
        assert main_text(f"<body><article><section class='{name}'><p>{long}</p></section>{STORY}</article></body>") == f"{long} {WANT}"


def test_several_wrappers_hold_the_text():
    half = STORY[:len(STORY) // 2]
    assert main_text(f"<body><div class='widget'>{STORY}</div><div class='widget'>{STORY}</div></body>") == f"{WANT} {WANT}"
    assert main_text(f"<body><div class='sidebar'>{STORY}</div><div class='sidebar'>{STORY}</div></body>") == f"{WANT} {WANT}"
    assert main_text(f"<body><nav>Home</nav><div class='menu'>{half}</div></body>").startswith("This is paragraph 0")


def test_pages_without_article_rest_on_the_ratios():
    """Link lists, short lines and comments, none of them named."""
    links = "<ul>" + "".join(f"<li><a href='/{k}'>Link number {k}</a></li>" for k in range(9)) + "</ul>"
    lines = "<div><span>Home</span></div><div><span>Log in</span></div>"
    story = "".join(f"<p>This is paragraph {k}, and it has a fair length, as texts do, with commas, and clauses, and more of "
                    f"them still, so that it reads as an article, not as a remark.</p>" for k in range(6))
    want = main_text(f"<body><article>{story}</article></body>")
    for page in (f"<body>{lines}{links}<div>{story}</div>{links}</body>",
                 f"<body><div>{links}</div><section><div>{story}</div></section><div>{lines}</div></body>",
                 f"<body><table><tr><td>{links}</td><td><div>{story}</div></td></tr></table></body>"):
        assert main_text(page) == want
    remarks = "<ol>" + "".join(f"<li><div>Anna {k}</div><span>I agree</span></li>" for k in range(5)) + "</ol>"
    assert main_text(f"<body><div>{story}</div><section>{remarks}</section></body>") == want


def test_path_values_by_hand():
    """Two paths, no smoothing: length a node, times one and the marks a node."""
    import numpy as np

    from tollstream.llm.extract import IN_ARTICLE, Paths, link_share, path_values

    tree = Paths()
    p, li = tree.below(0, "p"), tree.below(tree.below(0, "ul"), "li")
    inside = tree.below(tree.below(0, "article"), "p")
    paths = np.array([p, li, p, inside])
    value, spread = path_values(tree, paths, np.array([10.0, 4.0, 20.0, 5.0]), np.array([1.0, 0.0, 3.0, 0.0]), reach=0)
    assert value.tolist() == [45.0, 4.0, 45.0, 5.0 * IN_ARTICLE]
    assert spread == np.std([45.0, 4.0, 45.0, 5.0])
    share = link_share(tree, paths, np.array([1, 2, 1, 3]), np.array([10.0, 4.0, 30.0, 5.0]), np.array([10.0, 4.0, 0.0, 0.0]))
    assert share.tolist() == [0.25, 1.0, 0.25, 0.0]
