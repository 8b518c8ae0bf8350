"""Main text of HTML pages: a linear-chain conditional random field over DOM leaf blocks.

A page is read into leaf blocks, each with the tags and names of its ancestors. The field labels the
blocks of a page in a row as content or not, from features of the ancestors and the text and of the
neighbour's label; it is trained on labelled pages and decoded by Viterbi.
"""

from __future__ import annotations

import html
import random
import re
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import text_batches

#: Labelled pages the field is trained on, and gradient steps.
TRAINING_PAGES, STEPS = 400, 120

# Fixed sets of HTML element names.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
HIDDEN = frozenset("head script style template noscript iframe svg object canvas audio video textarea select title".split())
RAW = frozenset("script style textarea title noscript iframe template".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q ruby s samp small span strike strong sub sup time tt u var wbr "
    # MathML: a formula is a part of its sentence.
    "annotation annotation-xml maction math menclose merror mfenced mfrac mi mmultiscripts mn mo mover mpadded mphantom mprescripts mroot mrow ms mspace "
    "msqrt mstyle msub msubsup msup mtable mtd mtext mtr munder munderover none semantics".split()
)
CLOSES_P = frozenset(
    "address article aside blockquote details dialog div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split()
)
ENDS_ITSELF = {"li": "li", "dt": "dt dd", "dd": "dt dd", "tr": "tr", "td": "td th", "th": "td th", "option": "option"}
SCOPES = frozenset("html body div article section main aside nav header footer table ul ol dl form td th blockquote".split())

_TAG = re.compile(
    r"""<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>|<[!?][^>]*+(?:>|\Z)|</?[a-zA-Z][^>]*+\Z""",
    re.S,
)
_NAMES = re.compile(r"""(?:class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s>]+)""", re.I)
_ATTRIBUTE = re.compile(r"""([^\s/>=]+)(?:\s*=\s*("[^"]*(?:"|\Z)|'[^']*(?:'|\Z)|[^\s>]+))?""")
_MAY_HIDE = re.compile(r"hidden|display", re.I).search
_DISPLAY = re.compile(r"(?:^|;)\s*display\s*:\s*([^\s;!]*)", re.I).findall
_WORDS = re.compile(r"[a-zA-Z]+").findall
_ENDS = re.compile(r"[.!?…:]\W*$")


@dataclass
class Block:
    """Text of one leaf: ``path`` are its ancestors' tags, ``names`` the words of their class, id and role."""

    text: str
    path: tuple[str, ...]
    names: frozenset
    linked: float


@lru_cache(maxsize=4096)
def _name_words(attributes: str) -> tuple[str, ...]:
    found = " ".join(_NAMES.findall(attributes))
    return tuple(w.lower() for w in _WORDS(re.sub(r"([a-z])([A-Z])", r"\1 \2", found)))


@lru_cache(maxsize=4096)
def _hides(attributes: str) -> bool:
    """Whether an element with these attributes is hidden: by ``hidden``, ``aria-hidden=true`` or ``display: none`` in its style.

    Of an attribute given twice the first counts, of a style's displays the last.
    """
    own: dict[str, str] = {}
    for name, value in _ATTRIBUTE.findall(attributes):
        own.setdefault(name.lower(), html.unescape(value.strip(value[0]) if value[:1] in ("'", '"') else value))
    displays = _DISPLAY(own.get("style", ""))
    return "hidden" in own or own.get("aria-hidden", "").strip().lower() == "true" or bool(displays) and displays[-1].lower() == "none"


def blocks(page: str) -> list[Block]:
    """The leaf blocks of a page in order, hidden elements left out.

    Markup is read leniently: unclosed elements end with their parent, unknown end tags are ignored.
    Character references are decoded, white space becomes one space, blocks without text are left out.
    """
    out: list[Block] = []
    stack: list[tuple[str, tuple[str, ...], bool]] = []  # tag, name words, hidden
    parts: list[str] = []
    linked = links = hidden = 0

    def flush():
        nonlocal linked
        if parts:
            text = " ".join(html.unescape("".join(parts)).split())
            if text:
                names = frozenset(w for _, words, _ in stack for w in words)
                path = tuple(tag for tag, _, _ in stack if tag not in INLINE)
                out.append(Block(text, path, names, min(1.0, linked / max(1, len(text)))))
            parts.clear()
        linked = 0

    def drop(to: int):
        nonlocal hidden, links
        if any(tag not in INLINE for tag, _, _ in stack[to:]):
            flush()
        for tag, _, secret in stack[to:]:
            hidden -= secret
            links -= tag == "a"
        del stack[to:]

    def find(tags, stop) -> int:
        for i in range(len(stack) - 1, -1, -1):
            if stack[i][0] in tags:
                return i
            if stack[i][0] in stop:
                break
        return -1

    at, end = 0, len(page)
    while at < end:
        found = _TAG.search(page, at)
        text = page[at : found.start() if found else end]
        if text and not hidden:
            parts.append(text)
            if links:
                linked += len(text.strip())
        if not found:
            break
        at = found.end()
        tag = (found[2] or found[5] or "").lower()
        if not tag:
            continue
        attributes = found[3] or found[6] or ""
        if found[1] or found[4]:  # an end tag
            if tag == "br":
                parts.append(" ")
            elif (i := find((tag,), ())) >= 0:
                drop(i)
            continue
        if tag == "br":
            parts.append(" ")
            continue
        if tag not in INLINE:
            flush()
            if tag in CLOSES_P and (i := find(("p",), SCOPES)) >= 0:
                drop(i)
            if tag in ENDS_ITSELF and (i := find(tuple(ENDS_ITSELF[tag].split()), ("ul", "ol", "dl", "table", "select"))) >= 0:
                drop(i)
            if tag == "body" and (i := find(("head",), ())) >= 0:
                drop(i)
        if tag in VOID or attributes.endswith("/") and tag not in SCOPES and tag not in RAW and tag != "p":
            continue
        if tag in RAW:
            closing = re.compile(rf"</{tag}\b[^>]*>", re.I).search(page, at)
            at = closing.end() if closing else end
            continue
        if tag == "a" and (i := find(("a",), SCOPES)) >= 0:
            drop(i)
        secret = tag in HIDDEN or bool(attributes and _MAY_HIDE(attributes) and _hides(attributes))
        stack.append((tag, _name_words(attributes) if "=" in attributes else (), secret))
        hidden += secret
        links += tag == "a"
    flush()
    return out


# What the words of class, id and role names stand for.
NAME_GROUPS = {
    "main": "article content main post entry story body text prose copy abstract",
    "menu": "nav navigation menu navbar breadcrumb breadcrumbs tabs pagination pager toc topbar skip",
    "head": "header masthead banner top logo brand",
    "foot": "footer foot bottom copyright colophon legal",
    "side": "sidebar side aside rail widget related recommended popular trending more tags tagcloud archive",
    "advert": "ad ads advert advertisement sponsor sponsored promo promotion dfp outbrain taboola banner",
    "notice": "cookie cookies consent notice gdpr alert popup modal overlay newsletter subscribe signup paywall message",
    "share": "share sharing social follow print meta byline author date tools toolbar",
    "comment": "comment comments reply replies disqus discussion respond thread reader readers",
    "form": "form search login input button contact",
}
_GROUP = {w: k for k, words in NAME_GROUPS.items() for w in words.split()}


def features(block: Block) -> list[str]:
    """The names of a block's features."""
    out = ["bias", "leaf:" + (block.path[-1] if block.path else "none")]
    inside = set(block.path)
    out += ["in:" + t for t in inside]
    groups = {_GROUP[w] for w in block.names if w in _GROUP}
    out += ["name:" + g for g in groups]
    if "article" in inside or "main" in inside or "main" in groups:
        out.append("held:main" if not groups - {"main"} and not inside & {"nav", "aside", "footer", "form", "header"} else "held:mixed")
    n = len(block.text)
    out.append("chars:%d" % min(6, n.bit_length() // 2))
    out.append("linked:%d" % round(3 * block.linked))
    out.append("sentence" if _ENDS.search(block.text) else "fragment")
    return out


class Field:
    """Weights of block features for each label and of each pair of neighbouring labels."""

    def __init__(self, index: dict[str, int], weights: np.ndarray, moves: np.ndarray):
        self.index, self.weights, self.moves = index, weights, moves

    def _emit(self, page: list[Block]) -> list[list[float]]:
        known, w = self.index, self.weights
        out = []
        for b in page:
            ids = [known[f] for f in features(b) if f in known]
            out.append(w[ids].sum(0).tolist())
        return out

    def decode(self, page: list[Block]) -> list[int]:
        """The likeliest labels of all blocks together (Viterbi); ties go to content."""
        if not page:
            return []
        (m00, m01), (m10, m11) = self.moves.tolist()
        emit = self._emit(page)
        a, b = emit[0]
        back = []
        for e0, e1 in emit[1:]:
            from0, from1 = int(b + m10 >= a + m00), int(b + m11 >= a + m01)
            a, b = (b + m10 if from0 else a + m00) + e0, (b + m11 if from1 else a + m01) + e1
            back.append((from0, from1))
        label = int(b >= a)
        out = [label]
        for step in reversed(back):
            label = step[label]
            out.append(label)
        return out[::-1]

    @classmethod
    def fit(cls, pages: list[tuple[list[Block], list[int]]], steps: int = STEPS, ridge: float = 0.02) -> Field:
        """Maximum conditional likelihood with a ridge, by Adam over forward-backward gradients of all pages."""
        pages = [(p, y) for p, y in pages if p]
        named = [[features(b) for b in p] for p, _ in pages]
        index = {f: i for i, f in enumerate(sorted({f for p in named for b in p for f in b}))}
        length = max(len(p) for p, _ in pages)
        n, size = len(pages), len(index)
        present = np.zeros((n, length, size), np.float32)
        mask, gold = np.zeros((n, length), bool), np.zeros((n, length), int)
        for i, (found, (_, y)) in enumerate(zip(named, pages, strict=True)):
            mask[i, : len(y)] = True
            gold[i, : len(y)] = y
            for t, b in enumerate(found):
                present[i, t, [index[f] for f in b]] = 1
        flat = present.reshape(-1, size)
        want = np.eye(2)[gold] * mask[..., None]
        pair = mask[:, 1:] & mask[:, :-1]
        want_moves = np.zeros((2, 2))
        np.add.at(want_moves, (gold[:, :-1][pair], gold[:, 1:][pair]), 1)
        x = np.zeros(2 * size + 4)
        m, v = np.zeros_like(x), np.zeros_like(x)
        for step in range(1, steps + 1):
            w, moves = x[: 2 * size].reshape(size, 2), x[2 * size :].reshape(2, 2)
            emit = (flat @ w.astype(np.float32)).astype(float).reshape(n, length, 2)
            ahead, behind = np.zeros((n, length, 2)), np.zeros((n, length, 2))
            ahead[:, 0] = emit[:, 0]
            for t in range(1, length):
                go = np.logaddexp.reduce(ahead[:, t - 1, :, None] + moves, axis=1) + emit[:, t]
                ahead[:, t] = np.where(mask[:, t, None], go, ahead[:, t - 1])
            for t in range(length - 2, -1, -1):
                go = np.logaddexp.reduce(moves + (emit[:, t + 1] + behind[:, t + 1])[:, None, :], axis=2)
                behind[:, t] = np.where(mask[:, t + 1, None], go, behind[:, t + 1])
            total = np.logaddexp(ahead[:, -1, 0], ahead[:, -1, 1])
            state = np.exp(ahead + behind - total[:, None, None]) * mask[..., None]
            both = ahead[:, :-1, :, None] + moves + (emit[:, 1:] + behind[:, 1:])[:, :, None, :] - total[:, None, None, None]
            both = (np.exp(np.minimum(both, 0)) * pair[..., None, None]).sum((0, 1))
            grad_w = flat.T @ (state - want).reshape(-1, 2).astype(np.float32)
            grad = np.concatenate([grad_w.ravel(), (both - want_moves).ravel()]) / n + ridge * x / n
            m, v = 0.9 * m + 0.1 * grad, 0.99 * v + 0.01 * grad * grad
            x -= 0.1 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
        return cls(index, x[: 2 * size].reshape(size, 2).copy(), x[2 * size :].reshape(2, 2).copy())


@dataclass
class _Maker:
    """Labelled pages of many layouts: what is content is known because the page is made here."""

    rng: random.Random
    truth: list[str] = field(default_factory=list)

    def words(self, least: int, most: int) -> str:
        n = self.rng.randint(least, most)
        return " ".join("".join(self.rng.choice("abcdefghijklmnopqrstuvwxyzé") for _ in range(self.rng.randint(1, 11))) for _ in range(n))

    def sentence(self, least: int = 3, most: int = 60) -> str:
        return self.words(least, most).capitalize() + self.rng.choice([".", ".", ".", "!", "?", ""])

    def content(self, tag: str, text: str, attributes: str = "") -> str:
        self.truth.append(text)
        inner = self.rng.choice([text, text, text, f"<b>{text}", f"<span>{text}</span>", f"<em>{text}</em>"])
        return f"<{tag}{attributes}>{inner}" + (f"</{tag}>" if self.rng.random() < 0.9 or tag != "p" else "")

    def menu(self) -> str:
        r = self.rng
        items = "".join(f'<li><a href="/{i}">{self.words(1, 3)}</a></li>' for i in range(r.randint(2, 8)))
        return r.choice([f"<nav><ul>{items}</ul></nav>", f'<ul class="menu">{items}</ul>', f'<div id="navigation"><ul>{items}</ul></div>'])

    def noise(self) -> str:
        r, s = self.rng, self.sentence(2, 25)
        return r.choice(
            [
                f'<div class="ad">{s}</div>', f'<div class="advertisement"><p>{s}</p></div>', f'<aside><p>{s}</p></aside>',
                f'<div class="sidebar"><h3>{self.words(1, 3)}</h3><p>{s}</p></div>', f'<div class="cookie-notice"><p>{s}</p></div>',
                f'<form action="/s"><label>{self.words(1, 3)}</label><input name="q"><button>{self.words(1, 1)}</button></form>',
                f'<div class="share"><a href="#">{self.words(1, 2)}</a> <a href="#">{self.words(1, 2)}</a></div>',
                f'<div class="related"><ul><li><a href="/x">{s}</a></li><li><a href="/y">{self.sentence(2, 12)}</a></li></ul></div>',
                f'<div role="alert" class="notice">{s}</div>', f'<section class="newsletter"><p>{s}</p></section>',
            ]
        )

    def comments(self) -> str:
        r = self.rng
        body = "".join(f"<{t}>{self.sentence(3, 40)}</{t}>" for t in [r.choice(["p", "li", "div"])] * r.randint(1, 4))
        return r.choice([f'<section class="comments"><h3>{self.words(1, 2)}</h3>{body}</section>', f'<div id="comments">{body}</div>', f'<ol class="comment-list">{body}</ol>'])

    def page(self) -> str:
        r = self.rng
        head = f"<head><title>{self.words(2, 8)}</title><style>p{{}}</style><script>var a;</script></head>"
        before = [r.choice([self.menu(), f"<header><h2>{self.words(1, 4)}</h2>{self.menu()}</header>", self.noise(), f'<div class="header">{self.words(1, 5)}</div>']) for _ in range(r.randint(0, 3))]
        inside = [self.content("h1", self.words(1, 12))] if r.random() < 0.85 else []
        for _ in range(r.randint(0, 9)):
            x = r.random()
            if x < 0.75:
                inside.append(self.content("p", self.sentence(1, 90)))
            elif x < 0.82:
                inside.append(self.content(r.choice(["h2", "h3"]), self.words(1, 6)))
            elif x < 0.9:
                inside.append("<ul>" + "".join(self.content("li", self.sentence(1, 12)) for _ in range(r.randint(1, 4))) + "</ul>")
            elif x < 0.94:
                inside.append("<blockquote>" + self.content("p", self.sentence(3, 30)) + "</blockquote>")
            else:
                inside.append(self.noise())
        if r.random() < 0.15:
            inside.append(self.comments())
        shell = r.choice(
            ["<article>{}</article>"] * 4
            + ["<main>{}</main>", '<div class="content">{}</div>', '<div id="main-content">{}</div>', '<main><article>{}</article></main>', '<div class="post"><div class="entry">{}</div></div>']
        )
        after = [r.choice([self.noise(), self.comments(), self.menu()]) for _ in range(r.randint(0, 3))]
        foot = [f"<footer>&copy; {self.sentence(2, 20)}</footer>", f'<div class="footer"><p>{self.sentence(2, 20)}</p></div>', ""][r.choice([0, 0, 1, 2])]
        return f"<html>{head}<body>{''.join(before)}{shell.format(''.join(inside))}{''.join(after)}{foot}</body></html>"


def labelled_pages(n: int = TRAINING_PAGES, seed: int = 5) -> list[tuple[list[Block], list[int]]]:
    """Pages as blocks and labels (1: content), made from layouts that know what their content is."""
    out = []
    for i in range(n):
        maker = _Maker(random.Random(seed * 1_000_003 + i))
        page = blocks(maker.page())
        truth = set(maker.truth)
        out.append((page, [int(b.text in truth) for b in page]))
    return out


@lru_cache(maxsize=1)
def trained() -> Field:
    """The field trained on :func:`labelled_pages`; the same for all sessions."""
    return Field.fit(labelled_pages())


def main_text(page: str, model: Field) -> str:
    """The content blocks of a page, joined by one space."""
    found = blocks(page)
    return " ".join(b.text for b, label in zip(found, model.decode(found), strict=True) if label)


def extract(pages: DataFrame, model: Field | None = None) -> DataFrame:
    """(page_id, url, text, n_chars) of pages (page_id, url, html); null html counts as empty.

    Pages without content give an empty text. Rows are kept one by one, null and repeated ids too;
    other columns are ignored.
    """
    model = model or trained()

    def run(batches):
        for batch in batches:
            urls, done = batch.column(1), 0
            for keys, texts in text_batches([batch.select(["page_id", "html"])]):
                found = [main_text(t, model) for t in texts]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys, batch.column(0).type), urls.slice(done, len(keys)), pa.array(found, pa.string()), pa.array([len(t) for t in found], pa.int64())],
                    ["page_id", "url", "text", "n_chars"],
                )
                done += len(keys)

    return pages.select(F.col("page_id").cast("bigint"), F.col("url").cast("string"), "html").mapInArrow(
        run, "page_id bigint, url string, text string, n_chars bigint"
    )
