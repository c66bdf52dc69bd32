import numpy as np
import pytest

from movegrid.llm import html_extract
from movegrid.llm.blocks import leaves
from tests.conftest import ROOT, SF_SMALL
from tests.llm.helpers import rows

DDL = "page_id long, url string, html string, text string"


def texts(page):
    return [b[1] for b in leaves(page)]


@pytest.mark.parametrize("page,want", [
    (None, []), ("", []), ("   ", []), ("plain", ["plain"]),
    ("<p>a&amp;b &lt;i&gt; &eacute;&#233;&#xe9; &copy\n\t x</p>", ["a&b <i> ééé © x"]),
    ("<p>one<p>two</p>three", ["one", "two", "three"]),
    ("<p><b>bold<br><p>next <i>x</i>y</p>", ["bold", "next xy"]),
    ("<script>var t='</p>';track(0);</script><style>p{}</style><p>x</p>", ["x"]),
    ("<SCRIPT type='a>b'>1 < 2</SCRIPT >y<!-- c --> z", ["y z"]),
    ("a<!-- never closed", ["a"]), ("<script>never closed", []), ("1 < 2 and 3 > 2", ["1 < 2 and 3 > 2"]),
    ("<ul><li>a<li>b</ul><table><tr><td>c<td>d<tr><td>e</table>", ["a", "b", "c", "d", "e"]),
    ("<p title='a > b'>q</p></div></p>r", ["q", "r"]), ("<title>t</title><p>x", ["x"]), ("<p>a\xa0　b", ["a b"]),
])
def test_leaves(page, want):
    assert texts(page) == want


@pytest.mark.parametrize("page,want", [
    ("<p>one <svg class=i/> two</p><p>three</p>", ["one two", "three"]),
    ("<p>one <svg class='i'> two</p><p>three</p><p><svg><path d=x /><svg><text>t</text></svg>u</svg>four", ["one two", "three", "four"]),
    ("<p>a<object data=x> b</p><canvas id=c><p>c<svg/>", ["a b", "c"]), ("<p>a <canvas>old browser</canvas>b <object>o</object>c", ["a b c"]),
    ("<title-bar>t</title-bar><p>a</p><style-guide>s</style-guide><template-x>b</template-x><script-x>c", ["t", "a", "sbc"]),
    ("<p>where <math><mi>x</mi><mo>=</mo><mn>1</mn></math> holds", ["where x=1 holds"]), ("<math/><p>a", ["a"]),
    ("<p title=don't>one</p><p>it's two</p>", ["one", "it's two"]), ('<p title=5">one</p><p>6" two', ["one", '6" two']),
    ("<p title='a>b' class=x>q</p><p data-x = \"y>z\" >r", ["q", "r"]), ("<p a='x'b=\"y>\"c=z>q", ["q"]),
    ("<script src='x'/><p>a</p><title /><p>b</p><iframe src=\"y\" /><p>c", ["a", "b", "c"]), ("<script src=/x/>code()</script><p>a", ["a"]),
    ("<svg><title/><style/></svg><p>a</p>", ["a"]), ("<svg><script>'</svg>'</script>x</svg>a", ["a"]),
    ("<template><p>x</p><template>y</template>z</template>a", ["a"]), ("a<template>never closed", ["a"]),
    ("<!--><p>a</p><!---><p>b</p><!-- x --><p>c", ["a", "b", "c"]), ("<script>'</scripts>'</script x>a", ["a"]),
    ('<p title="never closed>one', ["one"]), ("<p class=x", ["<p class=x"]),
])
def test_no_text_is_swallowed(page, want):
    assert texts(page) == want


def test_long_broken_markup_is_read_in_time():
    for piece in ("<svg>", "<p a=b c", "a='", "<svg><svg/></svg>", "= ", "<b c=\"d\" e"):
        assert isinstance(texts("<p>" + piece * 3000), list)


@pytest.mark.parametrize("wrap", ["<div>", "<font class=x>", "<b><i>"])
def test_deep_elements_are_on_the_path(wrap):
    page = "<article id=out>" + wrap * 300 + "<nav class=menu><p>a</nav><aside>b</aside><article>c</article>d</article>e"
    found = list(leaves(page))
    tags = [{n for e in b[0] for n in e} for b in found]
    assert [b[1] for b in found] == ["a", "b", "c", "d", "e"] and [b[0][-1][0] for b in found[:3]] == ["p", "aside", "article"]
    assert ["nav" in t for t in tags] == [True, False, False, False, False] and ".menu" in tags[0]
    assert ["aside" in t for t in tags] == [False, True, False, False, False]
    assert ["article" in t for t in tags] == [True] * 4 + [False] and ".out" in tags[3] and found[4][0] == ()


def test_labels_below_deep_wrappers(pages):
    model, _ = html_extract.train_labeller([r[0] for r in pages.select("html").collect()][:30], layouts=500)
    body = "<nav><ul><li><a href=1>Home</a></li><li><a href=2>News</a></li></ul></nav><article><h1>A title of it</h1><p>First paragraph of more text.</p></article><footer>&copy; us</footer>"
    for n in (0, 40, 300, 2000):
        found = list(leaves("<body>" + "<div>" * n + body))
        assert [bool(p > 0.5) for p in model.label([html_extract.Reader().page(found)])[0]] == [False, False, True, True, False]


def test_deep_paths_tell_as_much_as_whole_ones(monkeypatch):
    rng = np.random.default_rng(3)
    page = "".join(rng.choice(["<div class=c%d>x" % rng.integers(400), "<ul><li>y", "</div>", "<span id=s>", "</ul>", "<p>z"], p=[0.7, 0.01, 0.08, 0.1, 0.01, 0.1]) for _ in range(2500))
    page = "<div class=a><section>" * 300 + page
    short = list(leaves(page))
    monkeypatch.setattr("movegrid.llm.blocks.DEEP", 10 ** 9)
    whole = list(leaves(page))
    assert len(whole) == len(short) and max(len(b[0]) for b in whole) > 700 and max(len(b[0]) for b in short) < 600
    for a, b in zip(short, whole):
        assert a[1:] == b[1:] and np.array_equal(html_extract.path_places(a[0]), html_extract.path_places(b[0]))


def test_links_with_unquoted_addresses():
    assert [b[2] for b in leaves("<p><a href=http://x/>go</a> on")] == [2]


def test_paths_and_links():
    found = list(leaves('<div class="main Post" id=x><ul><li><a href=1>go</a> on</li></ul></div>'))
    assert found == [((("div", ".main", ".post", ".x"), ("ul",), ("li",)), "go on", 2)]
    assert next(leaves("<p><a href=1>x<p>y"))[2] == 1 and list(leaves("<p><a href=1>x</p><p>y"))[1][2] == 0


@pytest.fixture(scope="module")
def pages(spark):
    return spark.read.parquet(f"{SF_SMALL}/pages.parquet")


def test_gradients_of_the_lstm():
    rng = np.random.default_rng(1)
    net = html_extract.Lstm(rng)
    net.w = net.w.astype(np.float64)
    x, goal = rng.normal(size=(4, 3, html_extract.DIM)), rng.normal(size=(4, 3, html_extract.HIDDEN))
    loss = lambda: float((net.forward(x)[0] * goal).sum())
    dw, _ = net.backward(x, net.forward(x, True)[1], goal)
    for i, j in ((0, 0), (5, 20), (html_extract.DIM + 2, 40), (html_extract.DIM + 9, 7)):
        old = net.w[i, j]
        net.w[i, j] = old + 1e-3
        up = loss()
        net.w[i, j] = old - 1e-3
        down = loss()
        net.w[i, j] = old
        assert abs((up - down) / 2e-3 - dw[i, j]) < 5e-2 * (1 + abs(dw[i, j]))


def test_held_out_accuracy(pages):
    sample = [r[0] for r in pages.select("html").collect()]
    model, accuracy = html_extract.train_labeller(sample[:30], layouts=500)
    assert accuracy > 0.97
    read, right, total = html_extract.Reader(), 0, 0
    for page in sample[30:]:
        found = list(leaves(page))
        want = [any(e[0] == "article" for e in b[0]) for b in found]
        right += int(((model.label([read.page(found)])[0] > 0.5) == want).sum())
        total += len(found)
    assert right == total


def test_extract_over_awkward_rows(spark, pages):
    page = ('<body><nav><ul><li><a href=1>Home</a></li><li><a href=2>News</a></li></ul></nav><article><h1>A title of it</h1><p>First  paragraph &amp; more text here.</p>'
            "<p>Second paragraph, a little longer than the first.</p></article><div class=comments><p class=comment>nice one</p></div><footer>&copy; us</footer></body>")
    awkward = [(None, None, None), (1, "u", ""), (2, None, page), (2, None, page), (3, "v", "<p>" + "word " * 200_000 + "</p>"), (4, "w", "<script>x")]
    df = pages.select("page_id", "url", "html").unionByName(spark.createDataFrame([r for r in awkward], "page_id long, url string, html string"))
    df = df.selectExpr("*", "'x' AS text", "1 AS n_kept")
    got = rows(html_extract.main_text(html_extract.extract(df)))
    assert len(got) == df.count() and all(n == len(t) for *_, t, n in got)
    mine = [t for i, u, t, _ in got if i == 2 and u is None]
    assert mine == ["A title of it\n\nFirst paragraph & more text here.\n\nSecond paragraph, a little longer than the first."] * 2
    assert [t for i, u, t, _ in got if (i, u) in ((None, None), (1, "u"), (4, "w"))] == ["", "", ""]


def test_empty_table(spark):
    assert rows(html_extract.extract(spark.createDataFrame([], DDL))) == []


NAV = "<nav class=menu><ul><li><a href=/>Home</a></li><li><a href=/n>News</a></li><li><a href=/c>Contact us</a></li></ul></nav>"
TAIL = ("<aside class=sidebar><h3>Related</h3><ul><li><a href=1>Other story</a></li><li><a href=2>One more</a></li></ul></aside><div class=comments><h4>Bob</h4>"
        "<p>nice one, thanks for that</p><h4>Ann</h4><p>I do not agree with it</p></div><footer><p>&copy; 2024 The site. All rights reserved.</p></footer>")
BODY = ["<h1>A title of some words</h1>", "<p>The first paragraph has a few sentences in it. It goes on for a while, as such texts do.</p>", "<h2>Second heading</h2>",
        "<p>Some more text that belongs to the story and says a thing or two about it.</p>", "<h3>Third level heading</h3>", "<p>Short one.</p>",
        "<ol><li>First step of the recipe</li><li>Second step, with more words in it</li><li>Third</li></ol>", "<h4>Fourth level</h4>",
        "<dl><dt>Term</dt><dd>What the term means in this text.</dd></dl>", "<ul><li>Point one<ul><li>Sub point a</li><li>Sub point b</li></ul></li><li>Point two</li></ul>",
        "<h5>Fifth</h5>", "<p>See <a href=x>this page</a> and <a href=y>that one</a>.</p>", "<h6>Sixth</h6>",
        "<details><summary>More about it</summary><p>The hidden details are told in this paragraph at some length.</p></details>",
        "<table><tr><th>Year</th><th>Value</th></tr><tr><td>2020</td><td>17</td></tr></table>", "<p>And a last paragraph that ends the story well.</p>"]
FRAMES = ["<article>%s</article>", "<main>%s</main>", "<div class=post>%s</div>", "<div class=content>%s</div>", "<div class='entry-content'>%s</div>", "<div>%s</div>",
          "<div id=main><div>%s</div></div>"]


@pytest.mark.parametrize("part", [0, 1, 2])
def test_headings_and_lists_are_kept_in_any_frame(spark, part):
    """Pages written by hand, by labellers trained on three different samples."""
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet").select("html").where("length(html) BETWEEN 1 AND 20000").collect()
    model, _ = html_extract.train_labeller(sorted(r[0] for r in pages)[part::3])
    read, right, total = html_extract.Reader(), 0, 0
    rng = np.random.default_rng(7)
    for frame in FRAMES:
        for k in range(8):
            body = [b for b in BODY if k == 0 or rng.random() < 0.7]
            found = list(leaves("<html><body>" + NAV + frame % "".join(body) + TAIL + "</body></html>"))
            story = set(texts("".join(body)))
            want = np.array([b[1] in story for b in found])
            got = model.label([read.page(found)])[0] > 0.5
            right += int((got == want).sum())
            total += len(found)
            if k == 0 and frame == FRAMES[0]:
                assert [b[1] for b, p in zip(found, got) if p] == texts("".join(body))
    assert right >= 0.99 * total, (right, total)


def test_pieces_of_a_page_are_labelled_as_the_whole():
    model, read = html_extract.Labeller(3), html_extract.Reader()
    found = list(leaves(NAV + "".join(BODY) * 9 + TAIL))
    whole = model.label([read.page(found)])[0]
    for piece in (1, 7, 50, len(found), 10_000):
        assert np.allclose(model.label_long(found, read, piece), whole, atol=1e-5)


def test_a_page_of_very_many_cells_is_held_in_bounded_memory():
    import subprocess
    import sys
    code = ("import resource, numpy as np\nfrom movegrid.llm import html_extract as h\nfrom movegrid.llm.blocks import leaves\n"
            "page = '<table>' + '<tr><td>12</td><td>ab c</td></tr>' * 150_000 + '</table>'\nsame = {}\n"
            "found = [(same.setdefault(p, p), t, n) for p, t, n in leaves(page)]\nassert len(found) == 300_000\n"
            "p = h.Labeller(1).label_long(found, h.Reader())\nassert len(p) == 300_000\nprint(resource.getrusage(resource.RUSAGE_SELF).ru_maxrss // 1024)")
    out = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, cwd=ROOT, timeout=300)
    assert out.returncode == 0, out.stderr
    assert int(out.stdout) < 600, out.stdout
