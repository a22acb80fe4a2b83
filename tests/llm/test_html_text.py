import html
import re

import numpy as np
import pytest
from llm_helpers import SF, read

from tabscope.llm import html_text as h


def test_blocks():
    page = """<!DOCTYPE html><head><title>T</title><style>p{}</style></head><body class='x'><!-- no <p>no</p> --><nav><a href="a>b">Home&nbsp;&amp;  more</a></nav>
    <p>One <b>two</b>\n three<br>four<p>Five &lt;tag&gt; 1 < 2<script>var s = "<p>no</p>";</script> six</p><ul><li>a<li>b</ul><p"""
    assert [b.text for b in h.blocks(page)] == ["T", "Home & more", "One two three four", "Five <tag> 1 < 2 six", "a", "b"]
    first = h.blocks(page)[1]
    assert first.linked == 1.0 and "nav" in first.path and "class=x" in first.path and "~x" in first.path
    assert h.blocks("") == [] and h.blocks("<p>") == [] and [b.text for b in h.blocks("plain")] == ["plain"]
    assert [b.text for b in h.blocks("a</p></div>b<!-- open")] == ["a", "b"]
    assert [b.text for b in h.blocks("<p><a href='x>y</a> c")]  # an open quote ends somewhere


def test_drawings_and_objects_drop_nothing_else():
    for tag in ("svg", "object", "noscript", "template", "select"):
        texts = lambda page: [b.text for b in h.blocks(page.replace("svg", tag))]  # noqa: B023, E731
        assert texts("<article><p>a <svg class='icon'/> b</p><p>c</p></article><svg>x</svg><p>d") == ["a b", "c", "d"]
        assert texts("<article><p>a<svg class='icon'> b</p><p>c</p></article><p>d") == ["a b", "c", "d"]
        assert texts("<p>a<svg> b</p><p>c<svg>x</svg></p><p>d") == ["a b", "c", "d"]
        assert texts("<p>a<svg>x<svg>y</svg><script>'</svg>'</script><i title='</svg>'>z</i></svg > b</p></svg><p>c") == ["a b", "c"]
    assert [b.text for b in h.blocks("<p>a<textarea><svg></textarea>b<iframe><p>x</iframe></p><p>c")] == ["a b", "c"]
    assert len(h.blocks("<p>a<svg>" * 20_000)) == 20_000  # one pass


def test_gradients():
    model = h.Labeller(1)
    r = np.random.default_rng(0)
    pages = [([h.Block(f"w{i} word.", ("p", f"t{i % 3}"), 0.1 * i) for i in range(n)], r.integers(0, 2, n).tolist()) for n in (1, 4, 6)]

    def loss():
        x = model.inputs(h.features([p for p, _ in pages])).astype(float)
        laid, mask = model._lay(x, np.array([len(p) for p, _ in pages]))
        states = np.concatenate([model._states(laid, mask, "f")[0], model._states(laid, mask, "b")[0], laid], 2)
        p = h._sigmoid(states @ model.weights["out"] + model.weights["out_bias"])
        y = model._lay(np.concatenate([v for _, v in pages])[:, None].astype(np.float32), np.array([len(v) for v, _ in pages]))[0][:, :, 0]
        return -np.where(mask, y * np.log(p) + (1 - y) * np.log(1 - p), 0).sum() / mask.sum()

    grads = model._gradients(pages)
    for name, g in grads.items():
        at = np.unravel_index(abs(g).argmax(), g.shape)
        before, step = model.weights[name][at], 1e-2
        model.weights[name][at] = before + step
        up = loss()
        model.weights[name][at] = before - step
        down = loss()
        model.weights[name][at] = before
        assert np.isclose((up - down) / (2 * step), g[at], rtol=0.05, atol=1e-4), name


def truth(page):
    article = re.search(r"<article>(.*?)(</article>|\Z)", page, re.S).group(1)
    parts = re.split(r"<p>|</p>|<h1>|</h1>", article)
    return "\n".join(t for t in (" ".join(html.unescape(re.sub(r"<[^>]*>", "", x)).split()) for x in parts) if t)


@pytest.fixture(scope="module")
def model(spark):
    return h.train(read(spark, "pages"))


def test_query_finds_the_articles(spark):
    got = {r.page_id: r for r in h.op3_html_text(spark, SF).collect()}
    pages = read(spark, "pages").collect()
    assert len(got) == len(pages)
    assert np.mean([got[p.page_id].text == truth(p.html) for p in pages]) >= 0.98
    assert all(r.n_chars == len(r.text) for r in got.values())


def test_markup_that_it_was_not_shown(spark, model):
    words = [b.text for b in h.blocks(read(spark, "pages").first().html) if len(b.text) > 40][:4] * 2
    body = "".join(f"<p>{html.escape(w)}</p>" for w in words)
    page = f"<html><body><div id='menu'><ul><li><a href='/'>Home</a></li><li><a href='/b'>Blog</a></li></ul></div><div class='content'>{body}</div><div class='comments'><p>{words[0]}</p></div><div id='footer'>Copyright</div></body></html>"
    got = h.extract(spark.createDataFrame([(1, "u", page)], "page_id long, url string, html string"), model).first()
    lines = got.text.split("\n")
    assert lines[: len(words)] == words and "Home" not in lines and "Copyright" not in lines


def test_awkward_pages(spark, model):
    rows = [(1, None, None, "t", 1), (2, "u", "", "t", 1), (None, "u", "<nav><a>x</a></nav>", "t", 1), (4, "u", "<p>" * 3000 + "x " * 50_000, "t", 1), (4, "u", "<p>" * 3000 + "x " * 50_000, "t", 1)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text string, n_chars long")
    got = h.extract(df, model).collect()
    assert len(got) == 5 and [r.text for r in got if r.page_id in (1, 2)] == ["", ""]
    assert h.extract(df.limit(0), model).collect() == [] and len(h.extract(df, h.train(df.limit(0))).collect()) == 5
