"""Main text of web pages by a linear-chain conditional random field over leaf blocks.

A page is read into leaf blocks (runs of text between block-level tags) with the tags and the words of
class, id and role of all ancestors. Each block has a label, main text or other, whose score is the
sum of its features' weights and a weight for each pair of neighbouring labels. Weights are trained on
generated, labelled pages (``training_page``) by maximum likelihood; pages are decoded by Viterbi.
"""

from __future__ import annotations

import html as entities
import random
import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.llm._common import pieces, small_batches

# Element names of HTML.
_INLINE = frozenset(
    """a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr br img
    object canvas audio video map
    math semantics mrow mi mn mo ms mtext mspace msup msub msubsup mfrac msqrt mroot munder mover munderover mmultiscripts mtable mtr mtd mstyle mpadded mphantom menclose""".split()
)
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_UNSEEN = frozenset("script style template iframe svg title head annotation annotation-xml".split())
_RAW = frozenset("script style iframe title textarea".split())
#: An opening tag ends open ones of these names, up to one of the second set.
_ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "option": ({"option"}, {"select"}),
    "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}), "body": ({"head"}, set()),
}
# A quotation mark quotes only where a value begins; elsewhere it is a character like any other.
_TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:=\s*(?:"[^"]*"|'[^']*')|[^>])*+)>|</?[a-zA-Z].*\Z|</[^>]*(?:>|\Z)""", re.S)
_NAMES = re.compile(r"""(?:^|\s)(class|id|role|data-main)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.I)
_WORD = re.compile(r"[a-z]+")


@dataclass
class Block:
    text: str
    features: list[str]
    label: int = 0


@dataclass
class _Open:
    tag: str
    features: frozenset[str]
    unseen: bool
    label: int


@dataclass
class _Page:
    stack: list[_Open] = field(default_factory=lambda: [_Open("", frozenset(), False, 0)])
    parts: list[str] = field(default_factory=list)
    linked: int = 0
    links: int = 0
    blocks: list[Block] = field(default_factory=list)
    headed: bool = False

    def add(self, raw: str) -> None:
        if not self.stack[-1].unseen and raw:
            self.parts.append(raw)
            if self.links:
                self.linked += len(raw)

    def flush(self) -> None:
        if not self.parts:
            return
        raw, linked = "".join(self.parts), self.linked
        self.parts, self.linked = [], 0
        text = " ".join(entities.unescape(raw).split())
        if text:
            top = self.stack[-1]
            own = next((o.tag for o in reversed(self.stack) if o.tag not in _INLINE), "")
            self.headed |= own == "h1"
            words = text.count(" ") + 1
            share = linked / len(raw)
            own_features = ["bias", f"own={own}", f"words={min(7, words.bit_length())}", f"linked={min(4, int(share * 4.99))}"]
            own_features += [f"end={text[-1] in '.!?…:;\"”»)'}", f"headed={self.headed}"]
            if "©" in text:
                own_features.append("copyright")
            if "|" in text:
                own_features.append("bars")
            self.blocks.append(Block(text, [*own_features, *top.features], top.label))

    def pop_to(self, k: int) -> None:
        for o in self.stack[k:]:
            self.links -= o.tag == "a"
        del self.stack[k:]

    def start(self, tag: str, attributes: str) -> None:
        if tag not in _INLINE:
            self.flush()
            for k in range(len(self.stack) - 1, 0, -1):  # a block ends an open paragraph
                if self.stack[k].tag == "p":
                    self.pop_to(k)
                    break
                if self.stack[k].tag not in _INLINE:
                    break
        elif tag == "br":
            self.add(" ")
        if tag in _ENDS:
            ends, bounds = _ENDS[tag]
            for k in range(len(self.stack) - 1, 0, -1):
                if self.stack[k].tag in ends:
                    self.flush()
                    self.pop_to(k)
                elif self.stack[k].tag in bounds:
                    break
        if tag in _VOID:
            return
        top = self.stack[-1]
        features, label = {f"in={tag}"}, top.label
        for name, *values in _NAMES.findall(attributes) if attributes else ():
            value = "".join(values).lower()
            if name.lower() == "data-main":
                label = int(value == "1")
            else:
                features.update(f"named={w}" for w in _WORD.findall(value))
        self.links += tag == "a"
        self.stack.append(_Open(tag, top.features | features, top.unseen or tag in _UNSEEN, label))

    def end(self, tag: str) -> None:
        if tag not in _INLINE:
            self.flush()
        for k in range(len(self.stack) - 1, 0, -1):
            if self.stack[k].tag == tag:
                self.pop_to(k)
                break
            if tag in _INLINE and self.stack[k].tag not in _INLINE:
                break


def blocks(page: str) -> list[Block]:
    """Leaf blocks in page order, with character references decoded and white space made single blanks."""
    p, at, lower = _Page(), 0, None
    while m := _TOKEN.search(page, at):
        p.add(page[at : m.start()])
        at = m.end()
        if not m[2]:
            continue
        tag = m[2].lower()
        if m[1]:
            p.end(tag)
            continue
        p.start(tag, m[3])
        if tag in _RAW:
            lower = page.lower() if lower is None else lower
            lower = lower if len(lower) == len(page) else re.sub("[A-Z]", lambda c: c[0].lower(), page)
            stop = lower.find(f"</{tag}", at)
            stop = len(page) if stop < 0 else stop
            p.add(page[at:stop])
            at = stop
    p.add(page[at:])
    p.flush()
    return p.blocks


# Generated pages --------------------------------------------------------------------------------

# Names that web pages commonly give to parts other than the article, and to the article.
_OTHER_NAMES = {
    "menu": "nav navbar menu navigation topnav breadcrumb breadcrumbs mainmenu links toc pagination pager",
    "header": "header masthead banner topbar logo siteheader branding hero",
    "ad": "ad ads advert advertisement adsbox sponsored sponsor promo promotion adunit dfp commercial",
    "notice": "cookie cookies consent gdpr notice alert message warning banner privacy popup modal overlay paywall disclaimer",
    "sidebar": "sidebar side aside widget related recommended popular trending more widgets rail teaser",
    "form": "form newsletter subscribe signup login search contact subscription",
    "share": "share social sharing follow tags meta byline author buttons",
    "comments": "comments comment commentlist replies reply discussion disqus respond responses thread",
    "footer": "footer colophon copyright bottom legal sitefooter credits",
}
_MAIN_NAMES = "content article post entry story body text main maincontent articlebody postcontent entrycontent storybody".split()
_WRAPPERS = "wrapper container page layout row col wrap inner grid outer site app root".split()
_SYLLABLES = "an er the in on re st en or at ed is it al ou ti la de ra ne sch ung que ción é ü ß lo ver ma".split()


def training_page(seed: int) -> str:
    """A page drawn at random; what is main text stands in elements with data-main="1"."""
    r = random.Random(seed)

    def sentence(n: int) -> str:
        words = ["".join(r.choice(_SYLLABLES) for _ in range(r.randint(1, 4))) for _ in range(n)]
        return " ".join(words).capitalize() + r.choice([".", ".", ".", "!", "?", ""])

    def prose(lo: int, hi: int) -> str:
        return " ".join(sentence(r.randint(3, 18)) for _ in range(r.randint(lo, hi)))

    def inline(text: str) -> str:
        words = text.split(" ")
        if r.random() < 0.3:
            k, tag = r.randrange(len(words)), r.choice(["b", "i", "em", "strong", "a href='/x'", "span", "code"])
            words[k] = f"<{tag}>{words[k]}" + (f"</{tag.split()[0]}>" if r.random() < 0.9 else "")
        return " ".join(words)

    def links(n: int, lo: int = 1, hi: int = 4) -> str:
        items = [f'<a href="/{k}">{sentence(r.randint(lo, hi)).rstrip(".!?")}</a>' for k in range(n)]
        kind = r.random()
        if kind < 0.6:
            return "<ul>" + "".join(f"<li>{x}" + "</li>" * (r.random() < 0.9) for x in items) + "</ul>"
        return (" | " if kind < 0.8 else " ").join(items)

    def named(kind: str) -> str:
        name = r.choice(_OTHER_NAMES[kind].split())
        return r.choice([f' class="{name}"', f' id="{name}"', f' class="{name} {r.choice(_WRAPPERS)}"', f" class='{r.choice(_WRAPPERS)}-{name}'"])

    def other(kind: str, tag: str, inner: str) -> str:
        plain = tag in ("nav", "aside", "footer", "header", "form") and r.random() < 0.5
        return f'<{tag}{"" if plain else named(kind)} data-main="0">{inner}</{tag}>'

    def menu() -> str:
        return other("menu", r.choice(["nav", "nav", "div", "ul"]), links(r.randint(3, 9)))

    def header() -> str:
        return other("header", r.choice(["header", "header", "div"]), r.choice([sentence(2), f"<a href='/'>{sentence(2)}</a>", f"<p>{sentence(6)}</p>", f"<h2>{sentence(3)}</h2>{links(4)}"]))

    def advert() -> str:
        return other("ad", r.choice(["div", "div", "section", "ins", "p", "aside"]), r.choice([prose(1, 3), f"<p>{prose(1, 2)}</p>", f"<a href='/ad'>{sentence(5)}</a>"]))

    def notice() -> str:
        return other("notice", r.choice(["div", "section", "p", "noscript"]), f"{prose(1, 2)}<button>{sentence(1)}</button>" if r.random() < 0.7 else f"<p>{prose(1, 3)}</p>")

    def sidebar() -> str:
        return other("sidebar", r.choice(["aside", "div", "section"]), f"<h3>{sentence(2)}</h3>" + r.choice([links(5, 2, 9), f"<p>{prose(1, 3)}</p>", links(3) + f"<p>{prose(1, 2)}</p>"]))

    def form() -> str:
        return other("form", r.choice(["form", "form", "div"]), f"<label>{sentence(2)}</label><input type=text><select><option>{sentence(1)}<option>{sentence(1)}</select><p>{prose(1, 2)}</p><button>{sentence(1)}</button>")

    def share() -> str:
        return other("share", r.choice(["div", "ul", "p"]), r.choice([links(4, 1, 2), sentence(4)]))

    def comments() -> str:
        one = lambda: r.choice(["<div class='comment'>{}</div>", "<li>{}</li>", "<article>{}</article>", "<div>{}</div>"]).format(f"<b>{sentence(2)}</b><p>{prose(1, 5)}</p>")
        return other("comments", r.choice(["section", "div", "ol"]), f"<h3>{sentence(2)}</h3>" * (r.random() < 0.6) + "".join(one() for _ in range(r.randint(1, 5))))

    def footer() -> str:
        return other("footer", r.choice(["footer", "footer", "div"]), r.choice([f"&copy; {r.randint(1990, 2025)} {sentence(3)} &middot; {prose(1, 2)}", links(5), f"<p>{prose(1, 3)}</p>{links(3)}", f"&copy; {sentence(6)}"]))

    def piece() -> str:
        kind = r.random()
        if kind < 0.62:
            return f"<p>{inline(prose(1, 9))}" + ("<br>" + prose(1, 3)) * (r.random() < 0.1) + "</p>" * (r.random() < 0.85)
        if kind < 0.72:
            return f"<p>{inline(sentence(r.randint(1, 4)))}</p>"
        if kind < 0.80:
            h = r.choice(["h2", "h3", "h4"])
            return f"<{h}>{sentence(r.randint(1, 7))}</{h}>"
        if kind < 0.86:
            return "<ul>" + "".join(f"<li>{inline(sentence(r.randint(2, 14)))}" + "</li>" * (r.random() < 0.8) for _ in range(r.randint(2, 6))) + "</ul>"
        if kind < 0.90:
            return f"<blockquote>{r.choice(['<p>{}</p>', '{}']).format(prose(1, 3))}</blockquote>"
        if kind < 0.93:
            return "<table>" + "".join(f"<tr><td>{sentence(2)}</td><td>{sentence(r.randint(1, 5))}</td></tr>" for _ in range(r.randint(2, 4))) + "</table>"
        if kind < 0.96:
            return f"<figure><img src=x><figcaption>{sentence(r.randint(3, 9))}</figcaption></figure>"
        return r.choice([f"<pre>{sentence(9)}</pre>", f"<div>{prose(1, 4)}</div>", f"<section><p>{prose(1, 4)}</p></section>"])

    inner = [f"<h1>{sentence(r.randint(2, 9))}</h1>"] if r.random() < 0.85 else []
    if inner and r.random() < 0.15:
        inner = [f"<header>{inner[0]}</header>"]
    inner += [piece() for _ in range(r.choice([1, 1, 2, *range(1, 15)]))]
    for maker, rate in ((advert, 0.3), (share, 0.25), (sidebar, 0.12), (form, 0.1), (notice, 0.1), (menu, 0.05)):
        if r.random() < rate:
            inner.insert(r.randint(0, len(inner)), maker())
    tail = comments() if r.random() < 0.3 else ""
    if tail and r.random() < 0.4:
        inner.append(tail)
        tail = ""
    name = r.choice(_MAIN_NAMES)
    body = "".join(inner)
    shell = r.random()
    tag = "article" if shell < 0.45 else "main" if shell < 0.6 else r.choice(["div", "section"])
    attribute = "" if tag in ("article", "main") and r.random() < 0.6 else r.choice([f' class="{name}"', f' id="{name}"', f' class="{r.choice(_MAIN_NAMES)}-{name}"'])
    body = f'<{tag}{attribute} data-main="1">{body}</{tag}>'
    if r.random() < 0.2:
        body = f"<main>{body}</main>"
    before = [f() for f, rate in ((header, 0.5), (menu, 0.8), (notice, 0.3), (advert, 0.35), (form, 0.12), (sidebar, 0.1)) if r.random() < rate]
    after = [f() for f, rate in ((share, 0.15), (sidebar, 0.4), (advert, 0.25), (form, 0.2), (menu, 0.1), (notice, 0.1)) if r.random() < rate]
    r.shuffle(before)
    r.shuffle(after)
    page = "".join(before) + body + tail + "".join(after) + (footer() if r.random() < 0.85 else "")
    for _ in range(r.randint(0, 2)):
        page = f'<div class="{r.choice(_WRAPPERS)}">{page}</div>'
    return f"<!DOCTYPE html><html><head><title>{sentence(4)}</title><style>p{{}}</style></head><body><script>var a='</p>';</script>{page}</body></html>"


# The field --------------------------------------------------------------------------------------

#: Generated pages that the weights are trained on.
TRAINING_PAGES = 800


@dataclass
class Field:
    weights: dict[str, float]  # of main text against other
    change: np.ndarray  # [from, to]

    def labels(self, page: list[Block]) -> list[int]:
        """The likeliest sequence of labels, by Viterbi."""
        (oo, om), (mo, mm) = self.change.tolist()
        other, main, back = 0.0, 0.0, []
        get = self.weights.get
        for k, b in enumerate(page):
            emit = sum([get(f, 0.0) for f in b.features])
            if k == 0:
                other, main = 0.0, emit
                continue
            to_other, to_main = main + mo > other + oo, main + mm > other + om
            back.append((to_other, to_main))
            other, main = max(main + mo, other + oo), max(main + mm, other + om) + emit
        if not page:
            return []
        state, out = int(main > other), []
        for step in reversed(back):
            out.append(state)
            state = int(step[state])
        return [state, *out[::-1]][: len(page)] if back else [state]

    def text(self, html: str) -> str:
        page = blocks(html)
        return " ".join([b.text for b, label in zip(page, self.labels(page)) if label])


@lru_cache(maxsize=2)
def trained(pages: int = TRAINING_PAGES, steps: int = 200, rate: float = 0.1, decay: float = 1e-3) -> Field:
    """Maximum likelihood with a small penalty, by full-batch steps with forward and backward sums."""
    read = [p for p in map(blocks, map(training_page, range(pages))) if p]
    names = sorted({f for p in read for b in p for f in b.features})
    number = {f: k for k, f in enumerate(names)}
    longest = max(map(len, read))
    n, cells = len(read), n_cells(read, longest)
    flat = np.concatenate([np.array([number[f] for f in b.features]) for p in read for b in p])
    sizes = np.array([len(b.features) for p in read for b in p])
    starts, owner = np.r_[0, np.cumsum(sizes)[:-1]], np.repeat(np.arange(len(sizes)), sizes)
    gold = np.zeros((n, longest), int)
    gold.reshape(-1)[cells] = [b.label for p in read for b in p]
    length = np.array(list(map(len, read)))
    alive = np.arange(longest)[None] < length[:, None]
    w, t = np.zeros(len(names)), np.zeros((2, 2))
    m = [np.zeros_like(w), np.zeros_like(t)]
    v = [np.zeros_like(w), np.zeros_like(t)]
    for step in range(1, steps + 1):
        emit = np.zeros((n, longest, 2))
        flat_emit = np.zeros(n * longest)
        flat_emit[cells] = np.add.reduceat(w[flat], starts)
        emit[..., 1] = flat_emit.reshape(n, longest)
        a, b = np.zeros((n, longest, 2)), np.zeros((n, longest, 2))
        a[:, 0] = emit[:, 0]
        for k in range(1, longest):
            s = a[:, k - 1, :, None] + t[None]
            a[:, k] = np.where(alive[:, k, None], np.logaddexp(s[:, 0], s[:, 1]) + emit[:, k], a[:, k - 1])
        for k in range(longest - 2, -1, -1):
            s = t[None] + (emit[:, k + 1] + b[:, k + 1])[:, None, :]
            b[:, k] = np.where(alive[:, k + 1, None], np.logaddexp(s[..., 0], s[..., 1]), 0.0)
        z = np.logaddexp(a[:, -1, 0], a[:, -1, 1])
        p = np.exp(a[..., 1] + b[..., 1] - z[:, None])
        error = ((p - gold) * alive).reshape(-1)[cells]
        gw = np.bincount(flat, weights=error[owner], minlength=len(names)) / n + decay * w
        both = alive[:, 1:]
        pair = np.exp(a[:, :-1, :, None] + t[None, None] + (emit[:, 1:] + b[:, 1:])[:, :, None, :] - z[:, None, None, None]) * both[..., None, None]
        gt = pair.sum(axis=(0, 1))
        np.add.at(gt, (gold[:, :-1][both], gold[:, 1:][both]), -1.0)
        gt = gt / n + decay * t
        for k, (x, g) in enumerate(((w, gw), (t, gt))):
            m[k] = 0.9 * m[k] + 0.1 * g
            v[k] = 0.99 * v[k] + 0.01 * g * g
            x -= rate * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.99**step)) + 1e-8)
    return Field(dict(zip(names, w.tolist())), t)


def n_cells(pages: list[list[Block]], longest: int) -> np.ndarray:
    """Places of all blocks in a table with a row for each page."""
    return np.concatenate([np.arange(len(p)) + k * longest for k, p in enumerate(pages)])


def extract(pages: DataFrame, html_col: str = "html") -> DataFrame:
    """All columns and _text, the main text (empty if there is none).

    A null page is empty; repeated rows and null keys are rows like others, and no row is dropped; an empty
    table gives an empty one. Whole pages are read, whatever their length.
    """
    small_batches(pages.sparkSession)
    held = pages.sparkSession.sparkContext.broadcast(trained())  # bounded: one weight for each feature of the training pages

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            *rest, page = batch.columns
            yield pa.RecordBatch.from_arrays([*rest, pa.array([held.value.text(x) for x in page.to_pylist()], pa.string())], [*names, "text"])

    names = [f"c{k}" for k in range(len(pages.columns))]  # columns travel under names of their own, so that none clashes
    rows = pages.toDF(*names)
    schema = ", ".join(f"{n} {f.dataType.simpleString()}" for n, f in zip(names, pages.schema))
    page = F.coalesce(rows[names[pages.columns.index(html_col)]], F.lit(""))
    return rows.select(*names, page.alias("_h")).mapInArrow(run, f"{schema}, text string").toDF(*pages.columns, "_text")
