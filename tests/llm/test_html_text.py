import pytest

from zonemill.llm import html_text
from zonemill.llm.html_text import extract, fit, labelled_pages, leaf_blocks, main_text


@pytest.fixture(scope="module")
def field():
    return fit()


def test_held_out_accuracy(field):
    pages = labelled_pages(200, seed=99)
    right = [
        keep == bool(label)
        for page in pages
        for keep, (_, label) in zip(field.decode([b for b, _ in page]), page, strict=True)
    ]
    assert sum(right) / len(right) > 0.99


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var x = "</p><p>no";</script></head><body>
<nav><ul><li><a href="/a">Home</a><li><a href="/b">More</a></ul></nav><!-- <p>hidden</p> -->
<header><h1>The site</h1></header><div class="cookie-banner"><p>We use cookies to make this a better site for you.</p></div>
<article><h1>A title of words</h1><p>First  &eacute;\n text &amp; more,<br>with <b>bold</b> and <a href="x">a link</a>.
<p>Second text, which is long enough to be read as a paragraph &#8212; it is.</p>
<div class="ad">Buy this thing now, it is cheap.</div><aside><p>Related reading of other things.</p></aside></article>
<section class="comments"><h3>Comments</h3><div class="comment"><p>I liked this article very much, thank you for it.</p></div></section>
<form><label>Mail</label><input name="m"><button>Send</button></form><footer>&copy; somebody, all rights reserved.</footer></body></html>"""


def test_article_without_what_surrounds_it(field):
    assert main_text(PAGE, field) == (
        "A title of words\n\nFirst é text & more, with bold and a link.\n\n"
        "Second text, which is long enough to be read as a paragraph — it is."
    )


def test_cut_and_broken_markup():
    texts = lambda html: [b.text for b in leaf_blocks(html)]
    assert texts("<p>a <b>b<p>c</i>d</p>e<scr") == ["a b", "cd", "e"]
    assert texts("<p>a<script>never ends <p>b") == ["a"]
    assert texts("<p title='x>y'>a</p><p title=\"un>b") == ["a", "b"]
    assert texts("1 < 2 &lt;b&gt; <!-- open") == ["1 < 2 <b>"]
    assert texts("<textarea><p>x</textarea><ul><li>a<li>b</ul>") == ["a", "b"]
    assert texts("") == [] and texts("<br><p> </p>") == []


def test_table_of_pages(spark, field):
    long = "<article>" + "<p>Some text of a long page, again and again.</p>" * 4000 + "</article>"
    rows = [(1, PAGE, "x"), (2, None, "x"), (3, "", "x"), (4, long, "x"), (None, PAGE, "x"), (1, PAGE, "again")]
    df = spark.createDataFrame(rows, "page_id long, html string, text string")
    found = extract(df, field, keep=["page_id", "text"])
    assert found.columns == ["page_id", "text", "n_chars"]
    got = [(r["page_id"], r["text"], r["n_chars"]) for r in found.collect()]
    want = main_text(PAGE, field)
    assert got[0] == (1, want, len(want)) and got[1:3] == [(2, "", 0), (3, "", 0)] and got[4][1] == want
    assert got[3][1].count("\n\n") == 3999 and len(got) == 6
    assert extract(df.limit(0), field).count() == 0


def test_decoding_is_the_best_of_all_labellings(field):
    page = [b for b, _ in labelled_pages(3, seed=5)[1]][:9]
    rows = [[field.rows[f] for f in html_text.block_features(b, i == 0, i == len(page) - 1) if f in field.rows] for i, b in enumerate(page)]

    def score(labels):
        total = field.start[labels[0]] + sum(field.weights[r, k].sum() for r, k in zip(rows, labels, strict=True))
        return total + sum(field.moves[a, b] for a, b in zip(labels, labels[1:]))

    every = [[(n >> i) & 1 for i in range(len(page))] for n in range(1 << len(page))]
    assert [int(k) for k in field.decode(page)] == max(every, key=score)


@pytest.mark.parametrize("tag", ["svg", "select", "object", "canvas", "noscript", "template"])
def test_unclosed_elements_hide_nothing(tag):
    texts = lambda html: [b.text for b in leaf_blocks(html)]
    assert texts(f"<p>one</p><{tag}><p>two</p><{tag} a=b><p>three</p>") == ["one", "two", "three"]
    assert texts(f"<p>one</p><{tag}>gone</{tag}><p>two</p><script>x<p>three</p>") == ["one", "two"]
