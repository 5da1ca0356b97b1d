"""Main text: the pages' articles cut out by their markup, held-out layouts, hostile markup."""

import html
import random
import re
import time

import numpy as np
import pytest

from clicklens.llm import main_text, queries

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def pages(spark):
    return spark.read.parquet(f"{SF}/pages.parquet").select("page_id", "url", "html")


@pytest.fixture(scope="module")
def model(spark, pages):
    return main_text.fit(pages)


def plain(page):
    """Text of the article element, block by block."""
    inner = re.search(r"<article>(.*?)(?:</article>|$)", page, re.S)[1]
    blocks = [" ".join(html.unescape(re.sub(r"</?b>|<br>", " ", p)).split()) for p in re.split(r"</?(?:p|h1)>", inner)]
    return "\n".join(b for b in blocks if b)


def test_query_against_the_articles(lspark, pages):
    want = {r["page_id"]: plain(r["html"]) for r in pages.collect()}
    got = queries.QUERIES["op5_main_text"](lspark, SF).collect()
    assert {r["page_id"]: r["text"] for r in got} == want
    assert all(r["n_chars"] == len(r["text"]) for r in got)


def test_training_is_repeatable(pages, model):
    again = main_text.fit(pages)
    assert all(np.array_equal(again.w[k], model.w[k]) for k in model.w)


def test_held_out_layouts(pages, model):
    rng = np.random.default_rng(123)
    texts = [html.escape(b.text) for r in pages.limit(80).collect() for b in main_text.blocks_of(r["html"])]
    words = sorted({w for t in texts for w in t.split()})
    wrong = total = 0
    for _ in range(150):
        blocks, y = main_text.labelled_page(rng, texts, words)
        x, mask = main_text.padded([main_text.vectors(blocks)])
        wrong += int(((model.scores(x, mask)[:, 0] > 0.5) != (y > 0.5)).sum())
        total += len(y)
    assert wrong / total < 0.02


PAGE = """<html><head><title>T</title><script>var a = "<p>x</p>";</script></head><body>
<header><h1>The Site</h1></header><nav><ul><li><a href=/a>Home</a><li><a href=/b>News</a></ul></nav>
<div class="cookie-notice"><p>We use cookies. Accept them.</p></div>
<article><h1>A title &amp; more</h1><p>First   paragraph with <a href="/x">a link</a> in it.<p>Second &lt;b&gt; paragraph,
 over lines.<style>p{}</style></p><div class="ad">Buy this thing now.</div><p>Third and last paragraph of it.</p></article>
<aside class="sidebar"><h3>Related</h3><ul><li><a href=/c>Another story</a></li></ul></aside>
<section id="comments"><div class="comment"><p>I liked to read this story a lot.</p></div></section>
<form><label>Search</label><input></form><footer>&copy; 2024 The Site</footer></body></html>"""


def test_a_page_with_all_kinds(lspark, model):
    got = main_text.extract(lspark.createDataFrame([(PAGE,)], "html string"), model).first()["text"]
    assert got == "A title & more\nFirst paragraph with a link in it.\nSecond <b> paragraph, over lines.\nThird and last paragraph of it."


@pytest.mark.parametrize(
    "page, want",
    [
        ("", []), (None, []), ("plain text", ["plain text"]), ("<p>a<b>b</b> c</p>d", ["ab c", "d"]), ("<p>a<br>b", ["a b"]),
        ("<p>a</div>b</p>c", ["a", "b", "c"]), ("a<!-- x -->b<!-- open", ["ab"]), ("<p>1 < 2 & 3 > 2</p>", ["1 < 2 & 3 > 2"]),
        ("<script>x<p>y</script>z", ["z"]), ("<style>never closed", []), ('<a title="x>y">t</a>', ["t"]), ("&amp&eacute;&#233;&nbsp;x", ["&éé x"]),
        ('<p class="open>text</p><p>b</p>', ["text", "b"]), ("<p>\n \t</p><div> x\n\ny </div>", ["x y"]), ("<li>a<li>b<ul><li>c</ul>", ["a", "b", "c"]),
    ],
)
def test_blocks(page, want):
    assert [b.text for b in main_text.blocks_of(page)] == want


def test_paths():
    blocks = main_text.blocks_of('<div class="Post-Body x1"><p>a<p>b<ul><li>c<li>d</ul></div><p>e')
    assert [" ".join(b.path) for b in blocks] == ["div .post .body .x p"] * 2 + ["div .post .body .x ul li"] * 2 + ["p"]


def test_gradients_against_differences():
    rng = np.random.default_rng(0)
    m = main_text.Labeller.new(rng)
    m.w = {k: v.astype(np.float64) for k, v in m.w.items()}
    x = rng.normal(size=(5, 3, main_text.DIMS))
    mask = np.array([[1, 1, 1], [1, 1, 1], [1, 1, 0], [1, 1, 0], [1, 0, 0]], float)
    y = rng.integers(0, 2, mask.shape).astype(float)

    def loss():
        p = m.scores(x, mask)
        return -(mask * (y * np.log(p) + (1 - y) * np.log(1 - p))).sum() / mask.sum()

    g = m.gradients(x, mask, y)
    for k, w in m.w.items():
        for _ in range(3):
            at = tuple(int(rng.integers(n)) for n in w.shape)
            old, step = w[at], 1e-4
            w[at] = old + step
            up = loss()
            w[at] = old - step
            down = loss()
            w[at] = old
            assert abs((up - down) / (2 * step) - g[k][at]) < 2e-4


def test_odd_rows_and_empty_tables(lspark, model):
    rows = [(1, None, None, "t"), (1, None, None, "t"), (None, "u", "", "t"), (2, "u", "<p>" + "word " * 200_000, "t"), (3, "u", "<p>a</p>" * 20_000, "t")]
    pages = lspark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = main_text.extract(pages, model)
    assert got.columns == ["page_id", "url", "text"]
    texts = sorted((r["page_id"] or 0, r["text"][:4]) for r in got.collect())
    assert texts[:3] == [(0, ""), (1, ""), (1, "")] and len(texts) == 5
    none = pages.limit(0)
    assert main_text.extract(none, main_text.fit(none)).collect() == []


@pytest.mark.parametrize(
    "tag",
    ["<svg class=icon/>", '<svg class="icon" />', "<math/>", "<select><option>", "<noscript>", '<object data="x">', "<template>", "<iframe src=x>", "<svg>", "<div><svg></div>"],
)
@pytest.mark.parametrize("after", ["", "<svg><title>a</title><path d=x /></svg>", "<noscript>no</noscript><iframe>no</iframe>"])
def test_unclosed_raw_elements_take_no_text_along(tag, after):
    page = f"<html><body><header>{tag}</header><article><p>First text.</p>{after}<p>Second text.</p></article>{after}</body></html>"
    assert [b.text for b in main_text.blocks_of(page)] == ["First text.", "Second text."]


def test_closed_raw_elements_are_never_blocks():
    for name in sorted(main_text.RAW):
        page = f"<div><p>Before.<{name} class=x>inside <i>it</i></{name}><p>After.</div>"
        assert [b.text for b in main_text.blocks_of(page)] == ["Before.", "After."]
    nested = "<p>Before.</p><svg><svg><g></svg>x</svg><object><object></object><div>x</div></object><p>After.</p>"
    assert [b.text for b in main_text.blocks_of(nested)] == ["Before.", "After."]
    assert [b.text for b in main_text.blocks_of("<p>Before.</p><svg><p>Unclosed to the end.</p>")] == ["Before.", "Unclosed to the end."]
    assert main_text.blocks_of("<p>a</p>" + "<svg><select>" * 50_000)[0].text == "a"


def test_training_text_is_bounded_by_the_parameters(lspark, monkeypatch):
    pages = lspark.createDataFrame([(1, f"<p>{'a' * 50}</p><p>{'b' * 50}</p>")], "page_id long, html string")
    seen = []
    monkeypatch.setattr(main_text, "TRAIN_PAGES", 1)
    monkeypatch.setattr(main_text, "labelled_page", lambda rng, texts, words: (seen.append(texts), ([], []))[1])
    monkeypatch.setattr(main_text, "vectors", lambda blocks: blocks)
    monkeypatch.setattr(main_text, "train", lambda made: made)
    monkeypatch.setattr(main_text, "SAMPLE_BLOCK_CHARS", 7)
    main_text.fit(pages)
    monkeypatch.setattr(main_text, "SAMPLE_CHARS", 55)
    main_text.fit(pages)
    assert seen == [["a" * 7, "b" * 7], ["a" * 7]]


LONG = ['<a "' * 250_000, "<div>x" * 100_000, '<a ">"' * 150_000, "<b>" * 50_000 + "</i>" * 50_000, "<div>" * 50_000 + "<li>x" * 50_000 + "</q1>" * 50_000, "<!--" * 200_000]


@pytest.mark.parametrize("page", LONG, ids=[p[:6] for p in LONG])
def test_long_broken_pages_take_linear_time(page):
    began = time.process_time()
    main_text.blocks_of(page)
    assert time.process_time() - began < 10


def test_tags_end_as_the_pattern_finds_them():
    """The ends worked out from behind are those the pattern finds, whatever the quotes."""
    rng = random.Random(5)
    bits = ['<a "', "<p '", '"', "'", ">", "<", "<p>", "</p>", "x ", "<!--", "-->", "<!d>", '<img alt="a>b">', "</b >", "<b"]
    for _ in range(20_000):
        page = "".join(rng.choice(bits) for _ in range(rng.randint(1, 20)))
        want, got = [], []
        at = 0
        while m := main_text._TAG.search(page, at):
            at = m.end()
            want.append((m.start(), at, (m[2] or m[5] or "").lower(), bool(m[1] or m[4]), m[3] or m[6] or ""))
        tags, at = main_text.Tags(page), 0
        while t := tags.next(at):
            at = t.end
            got.append((t.start, t.end, t.name, t.closing, t.attributes))
        assert got == want, page


def test_a_page_scored_in_parts_has_the_scores_of_the_whole():
    blocks = main_text.blocks_of('<div>x<p class="q">y z</p>' * 500)
    model = main_text.Labeller.new(np.random.default_rng(0))
    x, mask = main_text.padded([main_text.vectors(blocks)])
    np.testing.assert_allclose(model.page_scores(blocks, 64), model.scores(x, mask)[:, 0], atol=1e-5)
