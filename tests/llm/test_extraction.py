"""Main text extraction: the parser, the network's gradients, held-out layouts and hand-written pages."""
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from prepwise.llm import blstm, extraction
from prepwise.llm.layouts import Layouts, chains, own_labels
from prepwise.llm.markup import parse

SF = "/root/testdata/sf0.001"


def texts(source):
    return [b[1] for b in parse(source).blocks]


def test_blocks():
    assert texts("<p>a <b>b</b>\n\t c<br>d<p>e</p>f") == ["a b c d", "e", "f"]
    assert texts("<script>x<p>y</p></script>a<style>b</style><!-- c --><![CDATA[d]]>e<title>t</title>") == ["ae"]
    assert texts("a &amp; b &lt;p&gt; &eacute;&#233;&#xe9; &nbsp; 1 &amp") == ["a & b <p> ééé 1 &"]
    assert texts("1 < 2 <3 </ x><a title='>'>z</a>") == ["1 < 2 <3 z"]
    assert texts("<ul><li>a<ul><li>b</ul><li>c</ul><table><tr><td>d<td>e<tr><td>f</table>g") == ["a", "b", "c", "d", "e", "f", "g"]
    assert texts("<b><div>a</div>b</b></div>c</p>d<script>never closed <p>x") == ["a", "b", "c", "d"]
    assert texts("a<p") == ["a"] and texts("a<p class='x") == ["a"] and texts("a</") == ["a</"] and texts("a<!-- b") == ["a"]
    assert texts("") == texts("<p></p> \n<br>") == []


def test_paths():
    page = parse("<div class='siteFooter col-2' id=x><p hidden>a<em>b</em></p></div><a href=1><p>cd</p></a>")
    paths = chains(page)
    assert [set(paths[b[0]]) for b in page.blocks] == [{"<div", "site", "footer", "sitefooter", "col", "2", "x", "<p", "=hidden"}, {"<a", "<p"}]
    assert [b[2] for b in page.blocks] == [0, 2]
    assert own_labels(parse("<p>a</p>")) is None
    assert own_labels(parse("<nav>a</nav><article><h1>b</h1><aside>c</aside><p>d</p></article>e")) == [0, 1, 0, 1, 0]


def test_hostile_pages_take_linear_time():
    for source in ("<div>" * 60_000 + "x", "<a '" * 60_000, "<" * 200_000, "<p>" * 60_000, "</x>" * 60_000, "<!--" * 60_000, "<li>a" * 30_000):
        parse(source)


def test_gradients():
    r = np.random.default_rng(3)
    w = {k: v.astype(np.float64) + r.normal(0, 0.05, v.shape) for k, v in blstm.start(extraction.DENSE).items()}
    pages = []
    for n in (3, 5, 1):
        keys = lambda m: (r.integers(0, 50, m), np.sort(r.integers(0, n, m)))               # noqa: E731
        pages.append((r.normal(size=(n, extraction.DENSE)), keys(9), keys(12), r.integers(0, 2, n).astype(float)))

    def loss():
        total = 0
        for dense, paths, words, labels in pages:
            x = blstm.inputs(w, dense, paths, words).astype(np.float64)[:, None]
            z = blstm.logits(w, x, np.ones((len(labels), 1, 1)))[:, 0]
            total += (np.logaddexp(0, z) - labels * z).sum()
        return total / sum(len(p[3]) for p in pages)

    drop, blstm.DROP = blstm.DROP, {1: (0.0, 0.0), 2: (0.0, 0.0)}
    try:
        grads = blstm._gradients(w, pages, np.random.default_rng(0))
    finally:
        blstm.DROP = drop
    for name, g in grads.items():
        for at in [np.unravel_index(np.argmax(np.abs(g)), g.shape)] + [tuple(r.integers(0, s) for s in g.shape) for _ in range(2)]:
            w[name][at] += 1e-3
            up = loss()
            w[name][at] -= 2e-3
            down = loss()
            w[name][at] += 1e-3
            assert abs((up - down) / 2e-3 - g[at]) < 2e-5 + 1e-2 * abs(g[at]), name


@pytest.fixture(scope="module")
def folder(spark):
    return extraction.fit(spark.read.parquet(f"{SF}/pages.parquet"))


def test_path_sums_and_stacks(folder):
    """Sums level by level equal sums along the path; pages in one stack get the odds they get alone."""
    labeller = extraction.Labeller.of(folder)
    made = Layouts([], [], 5)
    pages = [made.example()[0] for _ in range(30)] + [parse("")]
    together = labeller.odds(pages)
    for page, odds in zip(pages, together):
        want = np.array([sum((labeller.w["path"][extraction._hash(t)] for t in chains(page)[b[0]]), np.zeros(blstm.PATH_DIM)) for b in page.blocks])
        assert not page.blocks or np.allclose(labeller._paths([page]), want, atol=1e-4)
        assert np.allclose(labeller.odds([page])[0], odds, atol=1e-3)


def test_held_out_layouts(folder):
    """Other texts and other layouts than those of the fit."""
    labeller, made, right, total = extraction.Labeller.of(folder), Layouts([], ["Other words here"], 12345), 0, 0
    for _ in range(300):
        page, labels = made.example()
        found = labeller.odds([page])[0] > 0
        right, total = right + int((found == np.array(labels, bool)).sum()), total + len(labels)
    assert right / total > 0.97


WORDS = "the of and to in is for that with as was on are by from report city water house river music history people season".split()


def prose(r, n):
    return " ".join(r.choices(WORDS, k=n)).capitalize() + "."


def test_hand_written_pages(folder):
    r, labeller = random.Random(1), extraction.Labeller.of(folder)
    title, *body = [prose(r, n) for n in (6, 60, 80, 12, 70)]
    inner = f"<h1>{title}</h1>" + "".join(f"<p>{b}</p>" for b in body)
    menu = "<ul><li><a href=/a>Home</a></li><li><a href=/b>News</a></li><li><a href=/c>Contact</a></li></ul>"
    wanted = "\n".join([title, *body])
    pages = [
        f"<body><nav>{menu}</nav><article>{inner}</article><footer>&copy; 2024 Example. All rights reserved.</footer></body>",
        f"<div class=header><a href=/>My site</a>{menu}</div><div class='post-content'>{inner}</div><div id=sidebar><h3>Recent posts</h3>{menu}</div>",
        f"<div class=cookie-banner>We use cookies.<button>Accept</button></div><main>{inner}<aside class=ad>Buy now!</aside></main>"
        f"<div class=comments><h3>2 comments</h3><p>{prose(r, 30)}</p><form><label>Your name</label><button>Send</button></form></div>",
        f"<header><p>Site</p></header><article>{inner}</article><section id=comments><p>{prose(r, 40)}</p><p>{prose(r, 9)}</p></section><footer>Imprint</footer>",
        f"<form class=search><label>Search</label><input></form><div class=entry>{inner}</div><div class=newsletter>Subscribe to our newsletter</div>",
    ]
    assert labeller.texts(pages) == [wanted] * len(pages)


def test_edges(spark, folder):
    """Null and empty html, repeated rows, null ids, clashing names, long pages, empty tables."""
    long = "<article>" + "<p>some words of an article that goes on.</p>" * 40_000 + "</article>"
    rows = [(1, "u", None), (2, None, ""), (None, "v", "<article><p>A text of some words, in an article.</p></article>"), (3, "w", long), (3, "w", long)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumns({c: F.lit(1) for c in ("text", "n_chars", "h")})
    got = {(r["page_id"], r["url"], r["text"], r["n_chars"]) for r in extraction.extract(df.repartition(3), folder).collect()}
    text = "\n".join(["some words of an article that goes on."] * 40_000)
    assert got == {(1, "u", "", 0), (2, None, "", 0), (None, "v", "A text of some words, in an article.", 36), (3, "w", text, len(text))}
    assert extraction.extract(df, folder).count() == 5 and extraction.extract(df.limit(0), folder).count() == 0
