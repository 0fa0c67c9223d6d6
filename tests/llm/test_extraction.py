import random
import time

import numpy as np
import pytest

from levygrid.llm import boosting, extraction
from levygrid.llm.htmldom import Nodes
from tests.llm.frames import LONG

WORDS = [f"{a}{b}" for a in "ba de fi go lu mar sten tro".split() for b in "n r st ly ing ed".split()]


def prose(draw, n):
    return " ".join(draw.choice(WORDS) for _ in range(n)).capitalize() + "."


@pytest.fixture(scope="module")
def trees():
    draw = random.Random(1)
    pages = [
        f"<body><nav><ul><li><a>{prose(draw, 2)}</a></ul></nav><article><h1>{prose(draw, 5)}</h1>"
        + "".join(f"<p>{prose(draw, draw.randint(5, 60))}</p>" for _ in range(draw.randint(1, 8)))
        + f"</article><footer>&copy; {prose(draw, 4)}</footer></body>" for _ in range(150)
    ]
    return extraction.train(pages)


def test_held_out_layouts(trees):
    draw = random.Random(2)
    composer = extraction.Composer([prose(draw, 200) for _ in range(50)], seed=99)
    nodes = Nodes()
    for i in range(200):
        nodes.add_page(i, composer.page())
    kept = nodes.decode(trees.score(nodes.features()))
    size = np.array([len(t) for t in nodes.text])
    label = np.array(nodes.label)
    good = size[kept & (label == 1)].sum()
    assert good / size[kept].sum() > 0.97 and good / size[label == 1].sum() > 0.97


def test_choice_is_consistent_and_best():
    draw = np.random.default_rng(4)
    for _ in range(60):
        nodes = Nodes()
        nodes.add_page(0, "".join(draw.choice(["<div>", "</div>", "<p>x", "<b>y</b>"], 7)))
        score = draw.normal(size=len(nodes.page))
        kept = nodes.decode(score)
        parent = np.array(nodes.parent)
        assert kept[0] and (kept[parent[1:]] | ~kept[1:]).all()
        n, best = len(parent), -np.inf
        for mask in range(1 << n - 1):
            choice = np.array([True, *(mask >> i & 1 for i in range(n - 1))], bool)
            if (choice[parent[1:]] | ~choice[1:]).all():
                best = max(best, score[choice].sum())
        assert score[kept].sum() == pytest.approx(best)


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var a="</p><p>no</p>";</script></head>
<body class="x"><nav class=menu><ul><li><a href="#">Home</a><li><a href="#">News page</a></ul></nav>
<div class="cookie-notice"><p>We use cookies to make things better for you</p><button>OK</button></div>
<article><h1>Big &amp; title</h1><p>First <b>bo</b>ld   text&nbsp;here, with
 more words that follow in the same sentence.<p>Second paragraph with a <a href="#">link</a> and &lt;tags&gt; in it, long enough.
<div class="ad">Buy this now</div><!-- no <p>comment</p> --><ul><li>point one of the list<li>point two of the list</ul></article>
<div id="comments"><h3>Comments</h3><div class="comment"><p>I disagree with this article a lot</p></div></div>
<aside class="sidebar"><h3>Related</h3><a href="#">Other story</a></aside><footer>&copy; 2020 site</footer></body></html>"""


def test_page(trees):
    assert extraction.extract([PAGE, "", PAGE], trees) == [
        "Big & title First bold text here, with more words that follow in the same sentence. Second paragraph with a "
        "link and <tags> in it, long enough. point one of the list point two of the list", "",
    ] + extraction.extract([PAGE], trees)


BROKEN = ["<", "<p", "</p>", "<a href='x", "text only", "<script>never ends", "<!-- open", "<p>" * 3000, "<b>" * 3000 + "x",
          "<table><tr><td>1<td>2<tr><td>3</table>", "a < b > c", "&#xZZ; &bogus; &amp", "<p title=\"a>b\">c</p>", "\x00", "<a \"" * 2000]


def test_broken_markup(trees):
    texts = extraction.extract(BROKEN, trees)
    assert len(texts) == len(BROKEN)
    nodes = Nodes()
    nodes.add_page(0, BROKEN[9])
    assert [t for t in nodes.text if t] == ["1", "2", "3"]


def test_odd_rows(spark, trees):
    rows = [(1, "u", None, "x"), (2, None, "", "x"), (None, "u", PAGE, "x"), (4, "u", f"<article><p>{LONG}</p></article>", "x"), (4, "u", PAGE, "x")]
    schema = "page_id long, url string, html string, text string"
    frame = spark.createDataFrame(rows, schema)
    got = extraction.main_texts(frame, trees).collect()
    assert len(got) == 5 and all(r["n_chars"] == len(r["text"]) for r in got)
    assert [r["text"] for r in got if r["page_id"] in (1, 2)] == ["", ""]
    assert LONG in {r["text"] for r in got}
    empty = spark.createDataFrame([], schema)
    assert extraction.main_texts(empty, extraction.fit_on(empty)).count() == 0
    assert extraction.main_texts(frame, extraction.fit_on(frame)).count() == 5


def test_large_pages_only(spark, monkeypatch):
    draw = random.Random(5)
    texts = [" ".join(prose(draw, 40) for _ in range(400)) for _ in range(6)]
    rows = [(i, "u", f"<nav><a>Home</a></nav><article><p>{t}</p></article><footer>&copy; site</footer>") for i, t in enumerate(texts)]
    assert min(len(r[2]) for r in rows) > 64 << 10
    frame = spark.createDataFrame(rows, "page_id long, url string, html string")
    for bound in (16 << 20, 1 << 17, 1 << 10):
        monkeypatch.setattr(extraction, "SAMPLE_BYTES", bound)
        got = {r["page_id"]: r["text"] for r in extraction.main_texts(frame, extraction.fit_on(frame)).collect()}
        assert [got[i] for i in range(6)] == texts


def test_sample_without_texts():
    assert extraction.extract([PAGE], extraction.train(["<p>a"]))[0].startswith("Big & title First bold text")


def test_boosting_learns():
    draw = np.random.default_rng(1)
    x = draw.normal(size=(3000, 5)).astype(np.float32)
    y = ((x[:, 0] > 0.3) ^ (x[:, 3] > -0.2)).astype(float)
    trees = boosting.fit(x[:2000], y[:2000])
    assert ((trees.score(x[2000:]) > 0) == y[2000:]).mean() > 0.95
    assert (boosting.fit(x, np.ones(3000)).score(x) > 0).all()


@pytest.mark.parametrize("attribute", ['data-y="12.5"', 'data-y=""', "data-y=x", "data-y", "y-0=1"])
def test_pages_cannot_label_themselves(trees, attribute):
    body = f"<article><p>{LONG[:400]}</p></article>"
    page = f"<body {attribute}><div {attribute}><p {attribute}>x</p></div>{body}</body>"
    nodes = Nodes()
    nodes.add_page(0, page)
    assert set(nodes.label) == {-1}
    extraction.train([page, page.replace("<", "&lt;")])
    assert extraction.extract([page], trees)[0].endswith(LONG[:400].strip())


@pytest.mark.parametrize("open_", ["<canvas>", "<svg>", "<object>", "<math>", "<noscript>", "<template>", "<iframe>"])
def test_unclosed_elements_swallow_nothing(open_):
    nodes = Nodes()
    nodes.add_page(0, f"<p>before {open_}</p><p>behind</p>" * 2)
    assert [t.strip() for t in nodes.text if t] == ["before", "behind"] * 2


def test_closed_elements():
    nodes = Nodes()
    nodes.add_page(0, "<p>so <math><mi>E</mi> = m</math> <svg><text>no</text></svg> <object>and</object></p><!-- x <b")
    assert " ".join(nodes.text).split() == ["so", "E", "=", "m", "and"]


@pytest.mark.parametrize("page", [
    "<a " * 350_000, "<div>" * 5000 + "</span>" * 100_000 + "x", "<svg>" * 150_000, "a<" * 400_000, "<!--" * 200_000,
])
def test_broken_markup_takes_linear_time(page):
    start = time.process_time()
    Nodes().add_page(0, page)
    assert time.process_time() - start < 20
