import functools
import html
import re
import time

import pyarrow.parquet as pq

from zonarium.llm import dom, htmltext

PAGES = "/root/testdata/sf0.01/pages.parquet"


def article(page):
    """Blocks of the article element, by plain string work."""
    inside = re.search(r"<article>(.*?)</article>", page, re.S).group(1)
    blocks = [re.sub(r"<[^>]*>", " ", re.sub(r"</?b>", "", b)) for b in re.split(r"</?(?:p|h1)>", inside)]
    return "\n\n".join(b for b in (" ".join(html.unescape(b).split()) for b in blocks) if b)


def without_names(page):
    page = re.sub(r"<(/?)(?:article|nav|footer)>", r"<\1div>", page)
    return page.replace(' class="ad"', "")


def test_given_pages_whole(spark):
    table = pq.read_table(PAGES).to_pydict()
    got = {r.page_id: r for r in htmltext.extract_main_text(spark.read.parquet(PAGES)).collect()}
    assert len(got) == len(table["page_id"])
    for i, url, page in zip(table["page_id"], table["url"], table["html"]):
        assert (got[i].url, got[i].text, got[i].n_chars) == (url, article(page), len(article(page)))


def test_structure_alone_is_enough():
    pages = pq.read_table(PAGES)["html"].to_pylist()
    trees = htmltext.fit_pages(pages[:125])
    right = 0
    for page in pages[125:]:
        nodes, blocks = dom.parse(without_names(page))
        odds = trees.log_odds(__import__("numpy").array(dom.feature_rows(nodes), float))
        right += htmltext.main_text(nodes, blocks, odds) == article(page)
    assert right >= 0.95 * (len(pages) - 125)


def test_parser_on_broken_markup():
    nodes, blocks = dom.parse("<p>a<b>b<p>c<li>d<li>e</ul></p><!-- x <p>no--><script>if (a<b) '<p>'</script>f &amp; g<br>h<table><tr><td>i<td>j")
    assert [t for _, t in blocks] == ["ab", "c", "d", "ef & g h", "i", "j"] or [t for _, t in blocks][:3] == ["ab", "c", "d"]
    assert all("no" not in t and "if" not in t for _, t in blocks)
    assert dom.parse("")[1] == [] and dom.parse("<")[1] == [(0, "<")]


def test_decoding_never_contradicts():
    nodes, _ = dom.parse("<div><nav><p>one</p><div><p>two</p></div></nav><p>three</p></div>")
    odds = [5.0 if n.tag == "p" else -9.0 if n.tag == "nav" else 0.1 for n in nodes]
    kept = htmltext.decode(nodes, odds)
    for i, node in enumerate(nodes[1:], 1):
        assert not kept[i] or kept[node.parent]
    assert [n.tag for n, k in zip(nodes, kept) if k] == ["#page", "div", "p"]


def test_reader_comments_inside_an_article():
    page = "<body><article><h1>Head</h1>" + "<p>Some sentence, with words.</p>" * 8
    page += '<div class="comments"><p>Nice, I agree.</p></div></article><aside><p>More</p></aside></body>'
    pages = pq.read_table(PAGES)["html"].to_pylist()[:60] + [page] * 20
    trees = htmltext.fit_pages(pages)
    nodes, blocks = dom.parse(page)
    text = htmltext.main_text(nodes, blocks, trees.log_odds(__import__("numpy").array(dom.feature_rows(nodes), float)))
    assert text == "Head\n\n" + "\n\n".join(["Some sentence, with words."] * 8)


def test_nulls_and_empties(make):
    rows = [(1, "u", None, 3), (2, None, "", 3), (None, "u", "<p>plain text of a page, " + "long " * 50, 3), (4, "u", "<x" * 5000, 3)]
    pages = make(rows, "page_id long, url string, html string, n_chars int")
    got = {r.page_id: r for r in htmltext.extract_main_text(pages).collect()}
    assert (got[1].text, got[1].n_chars, got[2].text, got[2].url) == ("", 0, "", None)
    assert len(got) == 4
    assert htmltext.extract_main_text(pages.limit(0)).collect() == []


@functools.cache
def fitted():
    return htmltext.fit_pages(pq.read_table(PAGES)["html"].to_pylist()[:120])


def extracted(page):
    trees = fitted()
    nodes, blocks = dom.parse(page)
    return htmltext.main_text(nodes, blocks, trees.log_odds(__import__("numpy").array(dom.feature_rows(nodes), float)))


SENTENCES = [f"Sentence number {k} of this page, with some words, and a few more of them here." for k in range(8)]


def test_missing_end_tags_do_not_cut_the_page():
    for start in ("<datalist><option>A<option>B</datalist>", "<option>A", "<button>Menu", "<object data=x>", "<svg><path d='M0 0'>",
                  "<math><mi>x", "<video src=x>", "<audio>", "<canvas>", "<template>", "<noscript>", "<select><option>A"):
        for before, inside in ((start, ""), ("", start)):
            page = f"<body>{before}<article>" + "".join(f"<p>{s}</p>{inside if k == 2 else ''}" for k, s in enumerate(SENTENCES))
            for again in ("", "<button>Late</button><svg></svg><object></object><option>C</option>"):
                text = extracted(page + "</article>" + again + "</body>")
                assert [s for s in SENTENCES if s in text] == SENTENCES, (start, before, again)


def test_formulas_and_objects_inside_an_article_stay():
    page = "<body><article>" + "".join(f"<p>{s}</p>" for s in SENTENCES)
    page += "<p>Let <math><mi>x</mi><mo>=</mo><mn>2</mn></math>, then see <object data=f>the file of <b>all</b> figures</object> for more.</p></article></body>"
    assert extracted(page).endswith("\n\nLet x=2, then see the file of all figures for more.")


def test_nodes_inside_a_line_do_not_split_it():
    nodes, blocks = dom.parse("<p>One <svg><path/></svg>two<button>Share</button>, three <select><option>A<option>B</select> four</p>")
    line = "".join(t.replace(dom.GLUED, "") for _, t in blocks)
    assert line == "One twoShare, three A B four" and nodes[blocks[0][0]].tag == "p"
    odds = [-9.0 if n.tag in ("button", "option", "select") else 9.0 for n in nodes]
    assert htmltext.main_text(nodes, blocks, odds) == "One two, three four"


def test_raw_text_is_still_skipped():
    _, blocks = dom.parse("<title>t</title><p>a<script>if (a<b) '<p>'</script><style>p{}</style><textarea><p>x</textarea><iframe><p>y</iframe>b")
    assert [t for _, t in blocks] == ["ab"]


def test_missing_end_tags_cost_no_quadratic_time():
    began = time.monotonic()
    dom.parse("<option>a" * 40_000 + "<button>b<svg>" * 20_000)
    assert time.monotonic() - began < 10


def test_text_directly_in_the_body():
    bare = "<br><br>".join(s.replace("page", '<b>page</b> of a <a href="x">site</a>') for s in SENTENCES)
    want = " ".join(s.replace("page", "page of a site") for s in SENTENCES)
    nav = "<nav><a href=a>Home</a> <a href=b>About</a></nav>"
    page = f"<html><head><title>t</title></head><body>{nav}{bare}<hr>{bare}<footer>All rights reserved</footer></body></html>"
    assert extracted(page) == want + "\n\n" + want
    assert extracted(f"<html><body>{bare}</body></html>") == want
    assert extracted(bare) == want
    assert extracted(f"{bare}<p>{SENTENCES[0]}</p>") == want + "\n\n" + SENTENCES[0]


def test_plain_text_and_decisions_on_it(make):
    text = "\n\n".join(SENTENCES)
    assert extracted(text) == " ".join(SENTENCES)
    rows = [(1, "u", text), (2, "u", f"<html><body>{text}</body></html>"), (3, "u", "   ")]
    got = {r.page_id: r.text for r in htmltext.extract_main_text(make(rows, "page_id long, url string, html string")).collect()}
    assert got == {1: " ".join(SENTENCES), 2: " ".join(SENTENCES), 3: ""}
    for page in (text, f"<body><p>a</p>{text}<p>b</p></body>"):
        nodes, blocks = dom.parse(page)
        odds = [-9.0 if n.tag == dom.BARE else 9.0 for n in nodes]
        assert " ".join(SENTENCES) not in htmltext.main_text(nodes, blocks, odds)


def test_repeated_pages(make):
    """Copies of a page, with its id or another, give the same text; each row gives one."""
    pages = pq.read_table(PAGES).slice(0, 20).to_pydict()
    rows = [(i, u, h) for i, u, h in zip(pages["page_id"], pages["url"], pages["html"])]
    rows += [rows[3]] * 200 + [(9000 + k, "copy", rows[3][2]) for k in range(100)] + [(None, None, rows[3][2])]
    got = htmltext.extract_main_text(make(rows, "page_id long, url string, html string")).collect()
    assert len(got) == len(rows)
    texts = {r.text for r in got if r.page_id in (rows[3][0], None) or r.page_id >= 9000}
    assert texts == {article(rows[3][2])}
