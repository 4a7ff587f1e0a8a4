"""Main text of web pages by a recurrent block labeller: a numpy bidirectional LSTM over a page's blocks."""

from __future__ import annotations

import html
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ship_package, tidied

#: Elements that don't end a block (those of formulas, too), that have no end tag, and whose content is not
#: text of the page.
INLINE = frozenset("a abbr b bdi bdo big cite code data del dfn em font i img ins kbd label mark object q s samp small span strike strong sub sup time tt u var wbr".split()) | frozenset("math mfrac mi mn mo mover mroot mrow ms mspace msqrt mstyle msub msubsup msup mtext munder munderover semantics".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template textarea title svg select iframe".split())
#: An open element of the kind that a start tag of one of these kinds ends, unless an element that may hold
#: one of its own is open inside of it.
ENDED_BY = {
    "p": frozenset("address article aside blockquote details div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr main nav ol p pre section table ul".split()),
    "li": frozenset(["li"]), "dt": frozenset(["dt", "dd"]), "dd": frozenset(["dt", "dd"]), "tr": frozenset(["tr"]), "td": frozenset(["td", "th", "tr"]), "th": frozenset(["td", "th", "tr"]),
}
HOLDERS = ("ul", "ol", "dl", "table", "article", "section", "div")
_TAG_NAME, _QUOTE_OR_END = re.compile(r"[a-zA-Z][^\s/>]*"), re.compile("[>\"']")
_NAMES = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_LONG_REFERENCE, _WORDS = re.compile(r"&#([0-9]{8,})"), re.compile(r"[^\W\d_]+|©")
_RAW_END = {tag: re.compile(rf"</{tag}(?=[\s/>])", re.I) for tag in RAW}
_SLOTS, _EMBED, _HIDDEN, _NUMBERS = 2048, 24, 16, 6


@dataclass(eq=False, slots=True)
class Place:
    """An open element: its tag and names, and the element around it (None: the page)."""

    tag: str
    names: tuple[str, ...]
    around: "Place | None"
    depth: int

    def path(self) -> tuple[str, ...]:
        out, at = [], self
        while at is not None:
            out.append(at.tag)
            at = at.around
        return tuple(out[::-1])


@dataclass
class Block:
    text: str
    place: Place | None
    linked: int = 0


class _Tags:
    """Finds where tags end: at the first > that is not inside a quoted value, in time linear in the page."""

    def __init__(self, page: str) -> None:
        self.page, self.last = page, {c: page.rfind(c) for c in ">\"'"}
        self.hopeless: set[int] = set()  # quotes from which no > outside of quotes follows

    def end(self, at: int) -> int:
        """The place of the > that ends the tag whose name ends at at; -1 if there is none."""
        page, i, seen = self.page, at, []
        while i <= self.last[">"]:
            m = _QUOTE_OR_END.search(page, i)
            i = m.end()
            if m[0] == ">":
                return m.start()
            if page[max(at, m.start() - 40) : m.start()].rstrip()[-1:] != "=":  # not the beginning of a value
                continue
            if m.start() in self.hopeless:
                break
            if i <= self.last[m[0]]:  # else it is never closed, and a character like others
                seen.append(m.start())
                i = page.index(m[0], i) + 1
        self.hopeless.update(seen)
        return page.find(">", at)


def _decoded(text: str) -> str:
    """Character references decoded; numbers that name no character may have any number of digits."""
    return html.unescape(_LONG_REFERENCE.sub(lambda m: "&#" + (m[1].lstrip("0") or "0")[:8], text))


def blocks_of(page: str) -> list[Block]:
    """The runs of text of a page, in page order, that no block element or line break parts; white space is collapsed.

    Takes time in proportion to the page, however its markup is nested or broken.
    """
    out, stack, run, linked, at, tags = [], [], [], 0, 0, _Tags(page)
    places: dict[str, list[int]] = {}  # for each tag, where the stack has it

    def end_block() -> None:
        nonlocal linked
        text = " ".join(_decoded("".join(run)).split()) if run else ""
        if text:
            out.append(Block(text, stack[-1] if stack else None, min(linked, len(text))))
        run.clear()
        linked = 0

    def put(text: str) -> None:
        nonlocal linked
        if text:
            run.append(text)
            if places.get("a"):
                linked += len(text)

    def cut(n: int) -> None:
        while len(stack) > n:
            places[stack.pop().tag].pop()

    look = 0
    while (lt := page.find("<" if look < tags.last[">"] else "<!--", look)) >= 0:
        look, second = lt + 1, page[lt + 1 : lt + 2]
        if page.startswith("<!--", lt):
            end = page.find("-->", lt + 4)
            put(page[at:lt])
            at = look = len(page) if end < 0 else end + 3
            continue
        if lt > tags.last[">"]:
            continue  # what follows is text and at most a comment
        if second in ("!", "?"):
            put(page[at:lt])
            at = look = page.index(">", lt) + 1
            continue
        m = _TAG_NAME.match(page, lt + 1 + (second == "/"))
        if m is None:
            continue  # a character like others
        put(page[at:lt])
        end = tags.end(m.end())
        tag, attrs = m[0].lower(), page[m.end() : end]
        at = look = end + 1
        if second == "/":
            if tag not in INLINE:
                end_block()
            if places.get(tag):
                cut(places[tag][-1])
            continue
        closed = attrs.rstrip().endswith("/")
        if tag in RAW:
            end_block()
            if not (tag == "svg" and closed):
                found = _RAW_END[tag].search(page, at)
                at = look = len(page) if found is None or found.start() > tags.last[">"] else page.index(">", found.start()) + 1
            continue
        if tag not in INLINE:
            end_block()
            for kind, by in ENDED_BY.items():
                if tag in by and places.get(kind):
                    deep = places[kind][-1]
                    if not any(places.get(x) and places[x][-1] > deep for x in HOLDERS):
                        cut(deep)
        if tag not in VOID and not closed:
            names = tuple(w for g in _NAMES.findall(attrs) for w in re.split(r"[^a-z]+", "".join(g).lower()) if w)
            places.setdefault(tag, []).append(len(stack))
            stack.append(Place(tag, names, stack[-1] if stack else None, len(stack)))
    put(page[at:])
    end_block()
    return out


def _slot(kind: str, word: str) -> int:
    return zlib.crc32(f"{kind}:{word}".encode()) % _SLOTS


class _Slots(dict):
    """Slots of words of one kind, kept over batches; all are forgotten when there are MOST_SLOTS."""

    def __init__(self, kind: str) -> None:
        super().__init__()
        self.kind = kind

    def __missing__(self, word: str) -> int:
        if len(self) >= MOST_SLOTS:
            self.clear()
        slot = self[word] = _slot(self.kind, word)
        return slot


#: Words of a kind whose slots a worker remembers at most.
MOST_SLOTS = 100_000
_TAG_SLOTS, _PAIR_SLOTS, _NAME_SLOTS, _WORD_SLOTS = (_Slots(kind) for kind in "tdnw")


@dataclass
class Features:
    """Hashed features of pages' blocks and of the elements around them; an element's sum holds those around it, too."""

    #: For each element its hashed features, the element around it (0: the page), and the elements of each depth.
    element: np.ndarray
    element_slot: np.ndarray
    around: np.ndarray
    depths: list[np.ndarray]
    #: For each block its element; (block, slot, weight) of its words, each by its share of the block's; its numbers.
    inside: np.ndarray
    block: np.ndarray
    slot: np.ndarray
    weight: np.ndarray
    numbers: np.ndarray

    def sums(self, table: np.ndarray) -> np.ndarray:
        """Each block's sum of its features' rows in table."""
        own = np.zeros((len(self.around), table.shape[1]))
        np.add.at(own, self.element, table[self.element_slot])
        for some in self.depths:
            own[some] += own[self.around[some]]
        out = own[self.inside]
        for i in range(0, len(self.block), 1 << 18):  # long pages have many words
            some = slice(i, i + (1 << 18))
            np.add.at(out, self.block[some], table[self.slot[some]] * self.weight[some, None])
        return out

    def gradient(self, given: np.ndarray, table: np.ndarray) -> None:
        """Adds to table what sums() passes back of given, a row for each block."""
        own = np.zeros((len(self.around), table.shape[1]))
        np.add.at(own, self.inside, given)
        for some in reversed(self.depths):
            np.add.at(own, self.around[some], own[some])
        np.add.at(table, self.element_slot, own[self.element])
        np.add.at(table, self.slot, given[self.block] * self.weight[:, None])


def vectors(pages: list[list[Block]]) -> Features:
    """The features of all blocks: whole tag paths with the names on them, and all words of every script."""
    at: dict[int, int] = {}  # of a Place by its identity
    element, element_slot, around, depth = [], [], [0], [0]
    inside, block, slot, weight, numbers = [], [], [], [], []
    for page in pages:
        for i, b in enumerate(page):
            new, x = [], b.place
            while x is not None and id(x) not in at:
                new.append(x)
                x = x.around
            for x in reversed(new):
                k = at[id(x)] = len(around)
                own = [_TAG_SLOTS[x.tag], *([_PAIR_SLOTS[f"{x.around.tag}>{x.tag}"]] if x.around else []), *map(_NAME_SLOTS.__getitem__, x.names)]
                element += [k] * len(own)
                element_slot += own
                around.append(at[id(x.around)] if x.around else 0)
                depth.append(x.depth + 1)
            words = _WORDS.findall(b.text.lower())
            said = Counter(words)
            block += [len(inside)] * len(said)
            slot += map(_WORD_SLOTS.__getitem__, said)
            total = len(words)
            weight += [c / total for c in said.values()]
            inside.append(at[id(b.place)] if b.place else 0)
            n = len(b.text)
            numbers.append((np.log1p(n) / 5, b.linked / n, sum(map(b.text.count, ".,;:!?")) / n, i / len(page), (len(page) - i) / len(page), float(b.text[-1] in ".!?")))
    depths = np.array(depth)
    order = np.argsort(depths, kind="stable")
    levels = np.split(order, np.flatnonzero(np.diff(depths[order])) + 1)[1:]
    return Features(np.array(element, np.int64), np.array(element_slot, np.int64), np.array(around), levels, np.array(inside, np.int64), np.array(block, np.int64), np.array(slot, np.int64), np.array(weight, float), np.array(numbers).reshape(-1, _NUMBERS))


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class Labeller:
    """embedding sums -> forward and backward LSTM -> probability that a block is main text."""

    def __init__(self, seed: int = 0) -> None:
        rng = np.random.default_rng(seed)
        d = _EMBED + _NUMBERS
        self.p = {"E": rng.normal(0, 0.1, (_SLOTS, _EMBED)), "out": rng.normal(0, 0.1, 2 * _HIDDEN), "bias": np.zeros(1)}
        for side in "fb":
            self.p[f"W{side}"] = rng.normal(0, 0.2, (d + _HIDDEN, 4 * _HIDDEN))
            self.p[f"B{side}"] = np.concatenate([np.zeros(_HIDDEN), np.ones(_HIDDEN), np.zeros(2 * _HIDDEN)])

    def _input(self, pages: list[list[Block]]) -> tuple:
        sizes, found = np.array([len(p) for p in pages]), vectors(pages)
        t, row = np.concatenate([np.arange(n) for n in sizes]), np.repeat(np.arange(len(pages)), sizes)
        back = sizes[row] - 1 - t
        return sizes, t, row, back, np.concatenate([found.sums(self.p["E"]), found.numbers], 1), found

    def _run(self, side: str, x: np.ndarray, learning: bool) -> tuple[np.ndarray, list]:
        """x (steps, pages, width), pages filled up at the end: hidden states, and what the way back needs in learning."""
        w, b, h, c, out, kept = self.p[f"W{side}"], self.p[f"B{side}"], np.zeros((x.shape[1], _HIDDEN)), np.zeros((x.shape[1], _HIDDEN)), np.zeros((*x.shape[:2], _HIDDEN)), []
        for t in range(len(x)):
            xh = np.concatenate([x[t], h], 1)
            z = xh @ w + b
            i, f, o = (_sigmoid(z[:, k * _HIDDEN : (k + 1) * _HIDDEN]) for k in range(3))
            g = np.tanh(z[:, 3 * _HIDDEN :])
            before, c = c, f * c + i * g
            h = o * np.tanh(c)
            out[t] = h
            if learning:
                kept.append((xh, i, f, o, g, before, c))
        return out, kept

    def probabilities(self, pages: list[list[Block]]) -> list[np.ndarray]:
        """Of each block of each page; pages are taken together with others of about their length."""
        order, out = sorted(range(len(pages)), key=lambda i: len(pages[i])), [np.zeros(0)] * len(pages)
        order = [i for i in order if pages[i]]
        at = 0
        while at < len(order):
            some = order[at : at + max(1, min(64, 60_000 // (len(pages[order[min(at + 63, len(order) - 1)]]) + 1)))]
            at += len(some)
            sizes, t, row, back, x, _ = self._input([pages[i] for i in some])
            z = self._forward(sizes, t, row, back, x, False)[0]
            for i, part in zip(some, np.split(_sigmoid(z), np.cumsum(sizes)[:-1]), strict=True):
                out[i] = part
        return out

    def _forward(self, sizes, t, row, back, x, learning: bool):
        padded, turned = np.zeros((sizes.max(), len(sizes), x.shape[1])), np.zeros((sizes.max(), len(sizes), x.shape[1]))
        padded[t, row], turned[back, row] = x, x
        (hf, kf), (hb, kb) = self._run("f", padded, learning), self._run("b", turned, learning)
        h = np.concatenate([hf[t, row], hb[back, row]], 1)
        return h @ self.p["out"] + self.p["bias"], h, kf, kb

    def gradients(self, pages: list[list[Block]], y: np.ndarray) -> dict[str, np.ndarray]:
        sizes, t, row, back, x, found = self._input(pages)
        z, h, kf, kb = self._forward(sizes, t, row, back, x, True)
        dz = (_sigmoid(z) - y) / len(y)
        g = {k: np.zeros_like(v) for k, v in self.p.items()}
        g["out"], g["bias"] = h.T @ dz, np.array([dz.sum()])
        dh, dx = dz[:, None] * self.p["out"], np.zeros_like(x)
        for side, kept, place, part in (("f", kf, t, dh[:, :_HIDDEN]), ("b", kb, back, dh[:, _HIDDEN:])):
            given = np.zeros((sizes.max(), len(sizes), _HIDDEN))
            given[place, row] = part
            dxs, next_h, next_c = np.zeros((sizes.max(), len(sizes), x.shape[1])), 0.0, 0.0
            for k in range(sizes.max() - 1, -1, -1):
                xh, i, f, o, gg, before, c = kept[k]
                d = given[k] + next_h
                tc = np.tanh(c)
                dc = d * o * (1 - tc * tc) + next_c
                dzz = np.concatenate([dc * gg * i * (1 - i), dc * before * f * (1 - f), d * tc * o * (1 - o), dc * i * (1 - gg * gg)], 1)
                g[f"W{side}"] += xh.T @ dzz
                g[f"B{side}"] += dzz.sum(0)
                both = dzz @ self.p[f"W{side}"].T
                dxs[k], next_h, next_c = both[:, : x.shape[1]], both[:, x.shape[1] :], dc * f
            dx += dxs[place, row]
        found.gradient(dx[:, :_EMBED], g["E"])
        return g


# --- training pages -----------------------------------------------------------------------------------------------

#: Names that writers of pages give to the parts around an article, and to the article (fixed values).
AROUND = {
    "nav": "nav menu navbar navigation breadcrumb breadcrumbs topnav links", "header": "header masthead banner top logo branding hero", "footer": "footer copyright bottom legal colophon imprint",
    "aside": "sidebar aside widget related recommended popular trending rail", "ad": "ad ads advert advertisement sponsor sponsored promo adbox banner", "notice": "cookie notice consent gdpr alert popup modal newsletter subscribe privacy warning message",
    "comments": "comments comment discussion replies responses reader disqus feedback", "share": "share social tools meta tags byline", "form": "form search login signup contact",
}
ARTICLE = "article content post entry story body text main post-content article-body entry-content page"


def training_page(rng: np.random.Generator) -> tuple[str, list[bool]]:
    """A made-up page and, for each of its blocks, whether it is main text."""
    syllables = "th er on an re he in ed nd ha at en es of or nt ea ti to it st io le is ou ar as de rt ve la que el os ion ung sch ei ü é ñ".split()

    def words(n: int, stop: bool) -> str:
        w = ["".join(rng.choice(syllables, rng.integers(1, 4))) for _ in range(n)]
        text = " ".join(w)
        style = rng.random()
        text = text.upper() if style < 0.08 else text if style < 0.3 else text.capitalize()
        return text + (rng.choice([".", ".", "!", "?", ""]) if stop else "")

    labels: list[bool] = []

    def leaf(tag: str, text: str, main: bool, link: bool = False) -> str:
        labels.append(main)
        inner = f'<a href="/x">{text}</a>' if link else text
        return f"<{tag}>{inner}</{tag}>"

    def named(kind: str) -> str:
        some = AROUND[kind].split()
        n = " ".join(rng.choice(some, min(len(some), int(rng.integers(1, 3))), replace=False))
        return f'id="{n.split()[0]}"' if rng.random() < 0.3 else f'class="{n}"'

    def around(kind: str) -> str:
        tag = {"nav": "nav", "header": "header", "footer": "footer", "aside": "aside", "form": "form"}.get(kind, rng.choice(["div", "section"]))
        bare = tag in AROUND and rng.random() < 0.5
        if tag in AROUND and not bare and rng.random() < 0.4:
            tag = "div"
        n, inside = int(rng.integers(1, 7)), ""
        if kind in ("nav", "aside", "share") and rng.random() < 0.8:
            inside = "<ul>" + "".join(leaf("li", words(int(rng.integers(1, 5)), False), False, True) for _ in range(n)) + "</ul>"
        elif kind == "comments":
            inside = "".join(leaf("p", words(int(rng.integers(2, 40)), True), False) for _ in range(n))
        elif rng.random() < 0.4:
            labels.append(False)
            inside = words(int(rng.integers(1, 30)), True)
        else:
            inside = "".join(leaf(rng.choice(["p", "div", "h3", "h2"]), words(int(rng.integers(1, 25)), True), False) for _ in range(int(rng.integers(1, 4))))
        return f"<{tag}{'' if bare else ' ' + named(kind)}>{inside}</{tag}>"

    before = "".join(around(rng.choice(["nav", "header", "ad", "notice", "form", "nav"])) for _ in range(rng.integers(0, 4)))
    inner = leaf("h1", words(int(rng.integers(1, 12)), rng.random() < 0.5), True) if rng.random() < 0.8 else ""
    for _ in range(int(rng.integers(1, 14))):
        r = rng.random()
        if r < 0.07:
            inner += around(rng.choice(["ad", "share", "form", "notice", "aside"]))
        elif r < 0.14:
            inner += "<ul>" + "".join(leaf("li", words(int(rng.integers(1, 15)), True), True) for _ in range(int(rng.integers(1, 5)))) + "</ul>"
        elif r < 0.2:
            inner += leaf(rng.choice(["h2", "h3", "blockquote", "pre", "td"]), words(int(rng.integers(1, 20)), rng.random() < 0.7), True)
        elif r < 0.3:
            labels += [True, True]
            inner += f"<p><b>{words(int(rng.integers(1, 30)), True)}<br>{words(int(rng.integers(1, 30)), True)}</p>"
        else:
            inner += leaf("p", words(int(rng.integers(1, 60)), True), True)
    if rng.random() < 0.2:
        inner += around("comments")
    tag = rng.choice(["article", "article", "article", "main", "div", "section"])
    name = "" if tag in ("article", "main") and rng.random() < 0.6 else f' class="{rng.choice(ARTICLE.split())}"'
    body = f"{before}<{tag}{name}>{inner}</{tag}>" + "".join(around(rng.choice(["footer", "comments", "aside", "ad", "nav", "share", "footer"])) for _ in range(rng.integers(0, 4)))
    if rng.random() < 0.2:
        body = f'<div class="{rng.choice(["wrapper", "container", "page", "site"])}">{body}</div>'
    return f"<html><head><title>{words(4, False)}</title><script>var a='<p>';</script></head><body>{body}</body></html>", labels


_trained: dict[int, Labeller] = {}


def train(pages: int = 700, epochs: int = 20, seed: int = 0) -> Labeller:
    """A labeller fitted on made-up pages with known labels, by Adam; the same seed gives the same one. Kept a process."""
    if seed in _trained:
        return _trained[seed]
    rng, data = np.random.default_rng(seed), []
    while len(data) < pages:
        page, y = training_page(rng)
        blocks = blocks_of(page)
        if blocks and len(blocks) == len(y):
            data.append((blocks, y))
    model, step = Labeller(seed), 0
    m, v = ({k: np.zeros_like(x) for k, x in model.p.items()} for _ in range(2))
    for epoch in range(epochs):
        order = sorted(rng.permutation(pages).tolist(), key=lambda i: len(data[i][0]) // 4)
        batches = [order[i : i + 30] for i in range(0, pages, 30)]
        for j in rng.permutation(len(batches)):
            some = [data[i] for i in batches[j]]
            g = model.gradients([b for b, _ in some], np.concatenate([y for _, y in some]).astype(float))
            step += 1
            rate = 0.02 if epoch < epochs * 0.7 else 0.005
            for k in model.p:
                m[k] = 0.9 * m[k] + 0.1 * g[k]
                v[k] = 0.99 * v[k] + 0.01 * g[k] ** 2
                model.p[k] -= rate * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.99**step)) + 1e-8)
    _trained[seed] = model
    return model


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row per input row: id, url, text (main text, blocks joined by a space; empty if none), n_chars (code points).

    Every block of the whole page is labelled with the blocks before and after it in view; those labelled main are kept
    whole, in order. Character references are decoded; comments, scripts, styles and other elements in RAW hold no
    text. A page takes time and memory in proportion to its length, whatever its markup. A null or empty page gives an empty text. Repeated rows and null ids or urls are treated like others; an empty
    table gives no rows; other columns play no part.
    """
    ship_package(pages.sparkSession)
    weights = pages.sparkSession.sparkContext.broadcast({k: v.astype(np.float32) for k, v in train().p.items()})  # some 60,000 numbers

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        from gridloom.llm import html_extract as H

        model = H.Labeller()
        model.p = weights.value
        for batch in batches:
            for i in range(0, batch.num_rows, 256):
                part = batch.slice(i, 256)
                blocks = [H.blocks_of(x or "") for x in part.column(2).to_pylist()]
                text = [" ".join(b.text for b, q in zip(own, p, strict=True) if q >= 0.5) for own, p in zip(blocks, model.probabilities(blocks), strict=True)]
                yield pa.record_batch([part.column(0), part.column(1), pa.array(text, pa.string()), pa.array([len(t) for t in text], pa.int64())], names=["key", "url", "text", "n_chars"])

    schema = f"key {pages.schema[id_col].dataType.simpleString()}, url string, text string, n_chars long"
    rows = pages.select(F.col(id_col).alias("key"), F.col(url_col).cast("string").alias("url"), F.col(html_col).alias("html"))
    return rows.mapInArrow(tidied(run), schema).withColumnRenamed("key", id_col)
