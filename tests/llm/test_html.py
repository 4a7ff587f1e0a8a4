import numpy as np
import pytest

from gridloom.llm import html_extract as H


def texts(page):
    return [b.text for b in H.blocks_of(page)]


def test_blocks():
    page = """<!DOCTYPE html><title>T &amp; t</title><style>p{}</style><script>var t="</p>";</script><!-- <p>no</p> -->
    <nav><ul><li><a href="/a>b">Home</a><li>Two</ul></nav><p>One <b>bold</b>ly&nbsp;&amp;\n\t more<br>next<p>third<div>inside</div> after &lt;tag&gt; &#233; <img alt="x>y">end</body>tail"""
    assert texts(page) == ["Home", "Two", "One boldly & more", "next", "third", "inside", "after <tag> é end", "tail"]
    own = H.blocks_of(page)
    assert own[0].place.path() == ("nav", "ul", "li") and own[0].linked == 4 and own[1].place.path() == ("nav", "ul", "li") and own[4].place.path() == ("p",) and own[5].place.path() == ("div",)
    assert texts("") == [] and texts("plain < text > & more") == ["plain < text > & more"] and texts("<script>never ends") == []
    assert texts("<p>a</i></section>b<!-- open") == ["ab"] or texts("<p>a</i></section>b<!-- open") == ["a", "b"]
    assert H.blocks_of('<div class="Ad-box x" id=top>y</div>')[0].place.names == ("ad", "box", "x", "top")
    assert texts("<b>" * 3000 + "deep") == ["deep"]
    assert texts("<p>so <math><mi>x</mi><mo>=</mo><mn>42</mn></math>, <object>fall <b>back</b></object>") == ["so x=42, fall back"]
    assert texts("<p class=don't>q</p><p title='a>b' id=\"c>d\">r</p><p a = \">\">s</p><p a=\"t>u") == ["q", "r", "s", "u"]
    assert texts("&#" + "0" * 6000 + "65; &#" + "1" * 6000 + "; &#x41; < 3 <3 </ <") == ["A \ufffd A < 3 <3 </ <"]


HOSTILE = ["<script ", '<a "x ', "<a ", "<b>x", "<div>y", "<!-- ", "<!", "<ul><li>z", "&", "='", '<a ="> <b "', "<p a='", "</p ", "<svg ", "<x y=\"", "<td>", "\"'>", "<a =\"'> "]


@pytest.mark.parametrize("unit", HOSTILE)
def test_hostile_pages_take_linear_time(unit):
    import time

    took = []
    for n in (50_000, 400_000):
        began = time.process_time()
        H.blocks_of("<a " + unit * (n // len(unit)) + ">")
        H.blocks_of(unit * (n // len(unit)))
        took.append(time.process_time() - began)
    assert took[1] < 30 * took[0] + 0.5 and took[1] < 8


def test_hostile_page_is_labelled():
    model = H.train()
    for unit in ("<b>x<div>", "<ul><li class='a b'>z ", "<p>word</p>"):
        blocks = H.blocks_of(unit * 8000)
        assert len(blocks) == 8000 and len(model.probabilities([blocks])[0]) == 8000


def test_gradients_by_differences():
    rng, model = np.random.default_rng(0), H.Labeller(3)
    pages = [H.blocks_of(H.training_page(rng)[0]) for _ in range(3)]
    pages = [p for p in pages if p]
    y = rng.integers(0, 2, sum(map(len, pages))).astype(float)

    def loss():
        args = model._input(pages)
        p = H._sigmoid(model._forward(*args[:5], False)[0])
        return -(y * np.log(p) + (1 - y) * np.log(1 - p)).mean()

    g = model.gradients(pages, y)
    for k in model.p:
        flat, own = model.p[k].reshape(-1), g[k].reshape(-1)
        for i in [int(np.abs(own).argmax()), len(flat) // 2]:
            old = flat[i]
            flat[i] = old + 1e-5
            up = loss()
            flat[i] = old - 1e-5
            down = loss()
            flat[i] = old
            assert own[i] == pytest.approx((up - down) / 2e-5, abs=1e-6)


def test_held_out_accuracy():
    model, rng, n, wrong = H.train(), np.random.default_rng(99), 0, 0
    for _ in range(200):
        page, y = H.training_page(rng)
        blocks = H.blocks_of(page)
        assert len(blocks) == len(y)
        if blocks:
            wrong += ((model.probabilities([blocks])[0] >= 0.5) != np.array(y)).sum()
            n += len(y)
    assert wrong / n < 0.015


def test_batches_make_no_difference():
    model, rng = H.train(), np.random.default_rng(5)
    pages = [H.blocks_of(H.training_page(rng)[0]) for _ in range(70)] + [[]]
    together = model.probabilities(pages)
    assert all(np.allclose(p, model.probabilities([b])[0]) for p, b in zip(together, pages) if b) and len(together[-1]) == 0


def test_pages(spark):
    page = '<html><body><nav><ul><li><a href="/x">Menu</a></li></ul></nav><div class="ad">Buy it now.</div><article><h1>Head &amp; title</h1><p>First long part of it, with words.<br><p>Second part of it, with more words.</article><footer>&copy; site 2020.</footer>'
    long = page.replace("<p>First", "<p>" + "Again some words to read. " * 8000 + "First")
    rows = [(1, "u", page, "x"), (1, "u", page, "x"), (2, None, None, "x"), (3, "v", "", "x"), (None, "w", long, "x")]
    got = sorted(map(tuple, H.extract(spark.createDataFrame(rows, "page_id long, url string, html string, text string")).collect()), key=str)
    body = "Head & title First long part of it, with words. Second part of it, with more words."
    longer = body.replace("title First", "title " + "Again some words to read. " * 8000 + "First")
    assert got == sorted([(1, "u", body, len(body)), (1, "u", body, len(body)), (2, None, "", 0), (3, "v", "", 0), (None, "w", longer, len(longer))], key=str)
    assert H.extract(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_vectors_take_whole_blocks():
    def slots(page):
        found = H.vectors([H.blocks_of(page)])
        assert len(found.inside) == 1
        sums = found.sums(np.eye(H._SLOTS))[0]
        return {int(i): sums[i] for i in np.flatnonzero(sums)}, found.numbers[0]

    words = "river stone tea house walk over under light table green".split()
    plain, _ = slots("<p>" + " ".join(words * 30) + "</p>")
    late, _ = slots("<p>" + " ".join(words * 30 + ["copyright"] * 100) + "</p>")
    assert H._slot("w", "copyright") not in plain and late[H._slot("w", "copyright")] == pytest.approx(100 / 400)
    assert sum(plain[H._slot("w", w)] for w in words) == pytest.approx(1)
    assert slots("<p>где где дом")[0][H._slot("w", "где")] == pytest.approx(2 / 3)  # words of every script
    assert slots("<p>" + "a" * 600 + "!" * 200)[1][2] == pytest.approx(0.25)  # a quarter of all characters
    deep, _ = slots('<aside class="advert">' + '<div class="one two three">' * 9 + "text")
    assert deep[H._slot("t", "aside")] == 1 and deep[H._slot("t", "div")] == 9 and deep[H._slot("d", "aside>div")] == 1
    assert deep[H._slot("n", "advert")] == 1 and deep[H._slot("n", "two")] == 9
