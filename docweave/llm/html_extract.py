"""Main text of web pages by a recurrent block labeller (operator 7).

A page becomes its sequence of leaf blocks: runs of text between block-level tags.  Each block is a vector of
hashed tag-path parts (tags, class and id words of all its ancestors), all its words, hashed, and statistics of
its text and links.  A bidirectional LSTM in numpy reads the whole sequence, so every label draws on the document
on both sides, and a logistic output on its states alone labels every block as main text or not.  It is trained
when first needed, on ``TRAIN_PAGES`` pages built by rule with a fixed seed, a third of them flat: there only the
blocks around a paragraph tell whether it is the article's or a comment's.

Pages are read in time linear in their length, whatever is left open: what a tag closes is looked up by name, and
a path is a chain of ancestors whose vectors are added up once.

Scripts, styles, templates, comments and the head have no blocks.  Character references are decoded, white
space inside a block (line breaks by tag included) becomes one blank, blocks are trimmed, and kept blocks are
joined in page order by two line feeds.

Defined results: a null or empty page, or one without main text, gives the empty text; unclosed tags and
comments end with the page, a tag with an unclosed quote at its first ">"; repeated rows give repeated rows; an empty table gives an empty table; columns
other than ``page_id``, ``url`` and ``html`` are not read.
"""

from __future__ import annotations

import html
import math
import random
import re
import zlib
from collections.abc import Iterable, Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table

PATH, WORDS, STATS, HIDDEN = 96, 64, 16, 24
INPUT = PATH + WORDS + STATS
TRAIN_PAGES, FLAT, EPOCHS, PAGES_AT_ONCE, SEED = 2000, 0.33, 16, 64, 3

BLOCK_TAGS = frozenset("address article aside blockquote body button caption dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr html label legend li main menu nav ol option p pre section select summary table tbody td tfoot th thead tr ul".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose content is never shown as text.
HIDDEN_TAGS = frozenset("script style template noscript svg annotation annotation-xml iframe object title head textarea canvas audio video".split())
#: Start tags that leave an open head open.
HEAD_TAGS = frozenset("base basefont bgsound link meta noframes noscript script style template title".split())
RAW = frozenset("script style title textarea iframe".split())
_RAW_ENDS = {t: re.compile(rf"</{t}\s*>", re.I) for t in RAW}
#: A start tag ends open elements of these kinds, up to the nearest of the second group.
CLOSES = {
    "p": ({"p"}, {"div", "article", "section", "td", "th", "li", "body", "main", "aside", "blockquote", "form", "footer", "header", "nav"}),
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "tr": ({"tr"}, {"table"}),
    "option": ({"option"}, {"select"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
}
_CLOSES_P = BLOCK_TAGS - {"body", "html", "option", "td", "th", "tr", "tbody", "thead", "tfoot", "caption", "li", "dt", "dd", "button", "label", "legend", "summary"}
_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)")
_MARKS = re.compile("[>\"']")
_NAMES = re.compile(r"""(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_MAY_HIDE = re.compile(r"hidden|display", re.I)
_ATTRIBUTE = re.compile(r"""([^\s"'>/=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
_NO_DISPLAY = re.compile(r"(?:^|;)\s*display\s*:\s*none", re.I)
_PARTS = re.compile(r"[a-z0-9]+")


def _hides(attrs: str) -> bool:
    """Whether an attribute of a start tag, not a word in some value, hides the element."""
    if not _MAY_HIDE.search(attrs):
        return False
    for name, *values in _ATTRIBUTE.findall(attrs):
        name, value = name.lower(), "".join(values).strip().lower()
        if name == "hidden" and not value.startswith("until") or name == "aria-hidden" and value == "true" or name == "style" and _NO_DISPLAY.search(value):
            return True
    return False


class Node:
    """An open element: its tag, its own path parts, and the node around it."""

    __slots__ = ("tag", "parts", "above", "depth", "hidden", "own", "_sums", "_near")

    def __init__(self, tag: str, parts: tuple[str, ...], above: Node | None, hidden: bool):
        self.tag, self.parts, self.above, self.hidden = tag, parts, above, hidden
        self.depth = len(parts) + (above.depth if above else 0)
        self.own = tag if tag in BLOCK_TAGS or above is None else above.own
        self._sums = self._near = None

    def path(self) -> Iterator[str]:
        """Path parts from the inside out: tags and, as ".word", class and id words."""
        node: Node | None = self
        while node is not None:
            yield from reversed(node.parts)
            node = node.above

    def sums(self) -> np.ndarray:
        """How often each hashed part is on the path."""
        todo, node = [], self
        while node is not None and node._sums is None:
            todo.append(node)
            node = node.above
        for n in reversed(todo):
            total = np.zeros(PATH, np.int32) if n.above is None else n.above._sums
            if n.parts:
                total = total.copy()
                for part in n.parts:
                    total[_part[part]] += 1
            n._sums = total
        return self._sums

    def vector(self) -> np.ndarray:
        """The path's vector: all parts, the nearest ones more."""
        if self._near is None:
            near = np.zeros(PATH, np.float32)
            for part in islice(self.path(), 6):
                near[_part[part]] += 0.4
            self._near = np.minimum(near + 0.6 * self.sums(), 2)
        return self._near


class Block:
    __slots__ = ("node", "text", "links", "linked")

    def __init__(self, node: Node, text: str, links: int, linked: int):
        self.node, self.text, self.links, self.linked = node, text, links, linked


class _Quotes:
    """Ends of tags. A quote that nothing closes is an ordinary character, and is looked for once a page."""

    def __init__(self, page: str):
        self.page, self.open = page, set()

    def end_of_tag(self, at: int) -> int:
        """Where the tag whose attributes begin at ``at`` ends: behind its ">", or the page's end."""
        page = self.page
        while m := _MARKS.search(page, at):
            at = m.end()
            mark = m[0]
            if mark == ">":
                return at
            if mark not in self.open and _after_equals(page, m.start()):
                stop = page.find(mark, at)
                if stop < 0:
                    self.open.add(mark)
                else:
                    at = stop + 1
        return len(page)


def _after_equals(page: str, at: int) -> bool:
    while at > 0 and page[at - 1] in " \t\r\n\f":
        at -= 1
    return at > 0 and page[at - 1] == "="


def blocks(page: str) -> list[Block]:
    """The page's leaf blocks in order."""
    out: list[Block] = []
    root = Node("", (), None, False)
    stack = [root]
    where: dict[str, list[int]] = {}  # places of the open elements of each tag in the stack
    outer = [0]  # places of the open block elements
    text: list[str] = []
    links = linked = 0
    size, quotes = len(page), _Quotes(page)

    def end() -> None:
        nonlocal text, links, linked
        if text:
            t = " ".join(html.unescape("".join(text)).split())
            if t:
                out.append(Block(stack[-1], t, links, linked))
            text = []
        links = linked = 0

    def say(part: str) -> None:
        nonlocal linked
        if part and not stack[-1].hidden:
            text.append(part)
            if where.get("a"):
                linked += len(part)

    def pop(to: int) -> None:
        while len(stack) > to:
            tag = stack[-1].tag
            if tag in BLOCK_TAGS:
                end()
                outer.pop()
            where[tag].pop()
            stack.pop()

    def last(tags: Iterable[str]) -> int:
        return max((at[-1] for t in tags if (at := where.get(t))), default=0)

    at = 0
    while at < size:
        start = page.find("<", at)
        if start < 0:
            say(page[at:])
            break
        say(page[at:start])
        if page.startswith("<!--", start) or page.startswith("<![CDATA[", start):
            close = "-->" if page[start + 2] == "-" else "]]>"
            stop = page.find(close, start + 4)
            at = stop + 3 if stop >= 0 else size
            continue
        if page[start + 1 : start + 2] in ("!", "?"):
            stop = page.find(">", start)
            at = stop + 1 if stop >= 0 else size
            continue
        m = _TAG.match(page, start)
        if m is None:
            say("<")
            at = start + 1
            continue
        at = quotes.end_of_tag(m.end())
        attrs = page[m.end() : at - 1] if page[at - 1] == ">" else page[m.end() : at]
        tag = m[2].lower()
        if m[1]:
            place = last((tag,))
            if place > (0 if tag in BLOCK_TAGS else outer[-1]):
                pop(place)
            elif tag in BLOCK_TAGS:
                end()
            continue
        if tag in RAW:
            stop = _RAW_ENDS[tag].search(page, at)
            at = stop.end() if stop else size
            continue
        if tag in ("br", "hr", "wbr"):
            if tag == "hr":
                end()
            elif tag == "br":
                say(" ")
            continue
        if tag in VOID:
            continue
        if stack[-1].tag == "head" and tag not in HEAD_TAGS:
            pop(len(stack) - 1)
        kinds, bounds = CLOSES.get(tag, ({"p"}, CLOSES["p"][1]) if tag in _CLOSES_P else ((), ()))
        if kinds and (place := last(kinds)) > last(bounds):
            pop(place)
        if tag in BLOCK_TAGS:
            end()
        if attrs.endswith("/") and tag not in BLOCK_TAGS and (len(attrs) == 1 or attrs[-2] in " \t\r\n\"'"):
            continue
        names = tuple("." + w for x in _NAMES.findall(attrs) for w in _PARTS.findall("".join(x).lower())) if "=" in attrs else ()
        if tag == "a":
            links += 1
        where.setdefault(tag, []).append(len(stack))
        if tag in BLOCK_TAGS:
            outer.append(len(stack))
        above = stack[-1]
        stack.append(Node(tag, (tag, *names) if tag in BLOCK_TAGS else names, above, above.hidden or tag in HIDDEN_TAGS or _hides(attrs)))
    pop(1)
    end()
    return out


class _Buckets(dict):
    """Hash buckets of words, remembered up to a limit."""

    def __init__(self, n: int):
        super().__init__()
        self.n = n

    def __missing__(self, word: str) -> int:
        if len(self) > 100_000:
            self.clear()
        x = self[word] = zlib.crc32(word.strip(".,:;!?()").encode("utf-8", "surrogatepass")) % self.n
        return x


_part, _word = _Buckets(PATH), _Buckets(WORDS)


def vectors(found: list[Block]) -> np.ndarray:
    """One row of INPUT numbers a block."""
    x = np.zeros((len(found), INPUT), np.float32)
    n = max(1, len(found) - 1)
    for i, b in enumerate(found):
        x[i, :PATH] = b.node.vector()
        words = b.text.lower().split()
        # Every word counts, less so in a long block.
        x[i, PATH : PATH + WORDS] = np.minimum(np.bincount([_word[w] for w in words], minlength=WORDS) / math.sqrt(len(words)), 1.5)
        size = len(b.text)
        marks = sum(map(b.text.count, ".,;:"))
        own = b.node.own
        x[i, PATH + WORDS :] = (
            math.log1p(size) / 6,
            math.log1p(len(words)) / 5,
            b.linked / max(1, size),
            min(b.links, 10) / 5,
            min(1, 8 * marks / max(1, size)),
            b.text[-1] in ".!?…\"»”",
            b.text[:1].isupper(),
            sum(map(b.text.count, "0123456789")) / size,
            own == "p",
            own in ("h1", "h2", "h3", "h4", "h5", "h6"),
            own == "li",
            own in ("td", "th", "dd", "dt", "pre", "blockquote"),
            i / n,
            min(b.node.depth, 48) / 12,
            "©" in b.text or "copyright" in b.text.lower(),
            own == "div",
        )
    return x


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


class BlockLabeller:
    """Bidirectional LSTM over block vectors with a logistic output on the states for each block."""

    def __init__(self, seed: int = SEED):
        rng = np.random.default_rng(seed)
        h = HIDDEN
        self.p: dict[str, np.ndarray] = {}
        for d in "fb":
            self.p[f"wx{d}"] = rng.normal(0, 1 / math.sqrt(INPUT), (INPUT, 4 * h))
            self.p[f"wh{d}"] = rng.normal(0, 1 / math.sqrt(h), (h, 4 * h))
            self.p[f"b{d}"] = np.concatenate([np.zeros(h), np.ones(h), np.zeros(2 * h)])
        self.p |= {"wo": rng.normal(0, 0.1, 2 * h), "bo": np.zeros(1)}

    def _pass(self, d: str, x: np.ndarray, mask: np.ndarray, keep: list | None) -> np.ndarray:
        """Hidden states (pages, blocks, HIDDEN) of one direction; keep: gets what the way back needs."""
        n, t, _ = x.shape
        h = HIDDEN
        u = x.reshape(n * t, -1) @ self.p[f"wx{d}"] + self.p[f"b{d}"]
        u = u.reshape(n, t, 4 * h)
        s, c, out = np.zeros((n, h)), np.zeros((n, h)), np.zeros((n, t, h))
        for k in range(t) if d == "f" else range(t - 1, -1, -1):
            z = u[:, k] + s @ self.p[f"wh{d}"]
            g = _sigmoid(z[:, : 3 * h])
            i, f, o, a = g[:, :h], g[:, h : 2 * h], g[:, 2 * h :], np.tanh(z[:, 3 * h :])
            m = mask[:, k : k + 1]
            c2 = f * c + i * a
            tc = np.tanh(c2)
            if keep is not None:
                keep.append((k, s, c, i, f, o, a, tc, m))
            s, c = m * (o * tc) + (1 - m) * s, m * c2 + (1 - m) * c
            out[:, k] = s
        return out

    def logits(self, x: np.ndarray, mask: np.ndarray, keep: dict | None = None) -> np.ndarray:
        states = [self._pass(d, x, mask, None if keep is None else keep.setdefault(d, [])) for d in "fb"]
        both = np.concatenate(states, 2)
        if keep is not None:
            keep["both"] = both
        return both @ self.p["wo"] + self.p["bo"][0]

    def gradients(self, x: np.ndarray, mask: np.ndarray, y: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        keep: dict = {}
        out = self.logits(x, mask, keep)
        p = _sigmoid(out)
        total = mask.sum()
        loss = -float((mask * (y * np.log(p + 1e-9) + (1 - y) * np.log(1 - p + 1e-9))).sum() / total)
        e = mask * (p - y) / total
        n, t, _ = x.shape
        h = HIDDEN
        g = {"wo": np.einsum("nt,nth->h", e, keep["both"]), "bo": np.array([e.sum()])}
        for d, part in (("f", slice(0, h)), ("b", slice(h, 2 * h))):
            wh, wo = self.p[f"wh{d}"], self.p["wo"][part]
            du, dwh = np.zeros((n, t, 4 * h)), np.zeros_like(wh)
            ds, dc = np.zeros((n, h)), np.zeros((n, h))
            for k, s, c, i, f, o, a, tc, m in reversed(keep[d]):
                ds = ds + e[:, k : k + 1] * wo
                dh, dcm = ds * m, dc * m
                dct = dcm + dh * o * (1 - tc * tc)
                z = np.concatenate([dct * a * i * (1 - i), dct * c * f * (1 - f), dh * tc * o * (1 - o), dct * i * (1 - a * a)], 1)
                du[:, k] = z
                dwh += s.T @ z
                ds = ds * (1 - m) + z @ wh.T
                dc = dc * (1 - m) + dct * f
            g |= {f"wx{d}": x.reshape(n * t, -1).T @ du.reshape(n * t, -1), f"wh{d}": dwh, f"b{d}": du.sum((0, 1))}
        return loss, g

    def fit(self, pages: list[tuple[np.ndarray, np.ndarray]], epochs: int = EPOCHS, rate: float = 0.01, batch: int = 24) -> BlockLabeller:
        """Adam on the mean logistic loss of pages given as (vectors, labels)."""
        rng = np.random.default_rng(SEED)
        m1, m2 = ({k: np.zeros_like(v) for k, v in self.p.items()} for _ in range(2))
        step, steps = 0, epochs * -(-len(pages) // batch)
        for _ in range(epochs):
            by_size = sorted(rng.permutation(len(pages)).tolist(), key=lambda i: len(pages[i][1]) // 8)
            parts = [by_size[k : k + batch] for k in range(0, len(by_size), batch)]
            rng.shuffle(parts)
            for part in parts:
                x, mask, y = _padded([pages[i][0] for i in part], [pages[i][1] for i in part])
                x[..., PATH : PATH + WORDS] *= rng.random((*x.shape[:2], 1)) > 0.4  # so that no label hangs on words alone
                step += 1
                for k, v in self.gradients(x, mask, y)[1].items():
                    v = np.clip(v, -1, 1)
                    m1[k] = 0.9 * m1[k] + 0.1 * v
                    m2[k] = 0.99 * m2[k] + 0.01 * v * v
                    self.p[k] = self.p[k] - rate * (1 - 0.95 * step / steps) * (m1[k] / (1 - 0.9**step)) / (np.sqrt(m2[k] / (1 - 0.99**step)) + 1e-8)
        self.p = {k: v.astype(np.float32) for k, v in self.p.items()}
        return self

    def label(self, pages: list[list[Block]]) -> list[np.ndarray]:
        """Which blocks of each page are main text."""
        out: list[np.ndarray] = [np.zeros(0, bool)] * len(pages)
        order = sorted((i for i, p in enumerate(pages) if p), key=lambda i: len(pages[i]))
        part: list[int] = []
        for k, i in enumerate(order):
            part.append(i)
            wide = len(pages[order[k + 1]]) if k + 1 < len(order) else None
            if len(part) >= PAGES_AT_ONCE or wide is None or (len(part) + 1) * wide > 20_000:
                x, mask, _ = _padded([vectors(pages[j]) for j in part], None)
                z = self.logits(x, mask)
                for r, j in enumerate(part):
                    out[j] = z[r, : len(pages[j])] > 0
                part = []
        return out


def _padded(xs: list[np.ndarray], ys: list[np.ndarray] | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    t = max(map(len, xs))
    x, mask, y = np.zeros((len(xs), t, INPUT), np.float32), np.zeros((len(xs), t), np.float32), np.zeros((len(xs), t), np.float32)
    for r, v in enumerate(xs):
        x[r, : len(v)] = v
        mask[r, : len(v)] = 1
        if ys is not None:
            y[r, : len(v)] = ys[r]
    return x, mask, y


KEEP, DROP = "\x02", "\x03"


def example_page(rnd: random.Random, flat: bool = False) -> str:
    """A page built by rule whose texts begin with KEEP or DROP. A flat one has no element or name that tells what
    a paragraph is: its article lies between a heading and another that announces comments or further reading."""
    word = lambda: "".join(rnd.choice(["an", "be", "ci", "do", "er", "fa", "gu", "ho", "in", "ka", "lo", "mi", "nu", "or", "pe", "ra", "su", "ti", "é", "ß", "ñ"]) for _ in range(rnd.randint(1, 5))) + rnd.choice([""] * 30 + ["###", "$$$", "***", "!!"])
    said = lambda a, b: " ".join(word() for _ in range(rnd.randint(a, b)))
    sentence = lambda: (said(1, 16).capitalize() + rnd.choice([".", ".", ".", "", "?", ", "]))
    odd = lambda: rnd.choice([lambda: " | ".join(said(1, 1).capitalize() for _ in range(rnd.randint(2, 20))), lambda: " ".join([word()] * rnd.randint(4, 40)), lambda: " ".join(str(rnd.randint(0, 99999)) for _ in range(rnd.randint(1, 12)))])()
    prose = lambda: odd() if rnd.random() < 0.2 else " ".join(sentence() for _ in range(rnd.choice([1, 1, 2, 4, 8])))
    link = lambda t: f'<a href="/{word()}">{t}</a>'
    body = lambda t, mark: f"<{t}>{mark}{prose()}" + rnd.choice([f"</{t}>"] * 4 + ["<br>"])
    name = lambda *x: f' class="{rnd.choice(x)}"'

    def menu(tag, n):
        items = "".join(f"<li>{link(DROP + said(1, 3))}</li>" for _ in range(n))
        return f"<{tag}{rnd.choice(['', name('menu', 'main-nav', 'navbar', 'breadcrumbs', 'links')])}><ul>{items}</ul></{tag}>"

    def furniture() -> str:
        one = lambda t: f"<{t}>{DROP}"
        return rnd.choice(
            [
                lambda: f"<div{name('ad', 'ads', 'advert', 'sponsored', 'promo banner')}>{DROP}{prose()}</div>",
                lambda: f"<aside{rnd.choice(['', name('sidebar', 'widget', 'related')])}><h3>{DROP}{said(1, 4)}</h3>{body('p', DROP)}<ul>" + "".join(f"<li>{link(DROP + said(2, 8))}</li>" for _ in range(rnd.randint(1, 6))) + "</ul></aside>",
                lambda: f"<div{name('sidebar', 'related-posts', 'widget', 'recommended')}><h4>{DROP}{said(1, 4)}</h4>" + "".join(f"<p>{link(DROP + said(2, 8))}</p>" for _ in range(rnd.randint(1, 5))) + "</div>",
                lambda: f"<div{name('cookie-notice', 'notice', 'banner', 'consent', 'alert')}>{one('p')}We use cookies {prose()}</p><button>{DROP}Accept</button></div>",
                lambda: f"<form{rnd.choice(['', name('newsletter', 'search', 'login', 'subscribe')])}><label>{DROP}{rnd.choice(['Subscribe', 'Search', 'Login', 'Email'])} {said(1, 4)}</label><input type=text><button>{DROP}{said(1, 2)}</button><p>{DROP}{prose()}</p></form>",
                lambda: f"<div{name('share', 'social', 'toolbar', 'tags')}>{link(DROP + 'Share')} {link(said(1, 1))}</div>",
            ]
        )()

    def comments() -> str:
        each = "".join(f"<{t}{name('comment', 'reply', 'comment-body')}><b>{DROP}{said(1, 2)}</b>{body('p', DROP)}</{t}>" for t in [rnd.choice(["div", "li", "article"])] for _ in range(rnd.randint(1, 5)))
        return f"<{(t := rnd.choice(['div', 'section', 'ol']))}{rnd.choice([name('comments', 'comment-list', 'discussion', 'responses'), ' id=comments'])}><h3>{DROP}{rnd.choice(['Comments', 'Reader comments', said(1, 2)])}</h3>{each}</{t}>"

    if flat:
        t, plain = rnd.choice(["p", "p", "div"]), rnd.choice(["", "", "<div>", '<div class="row">', "<section>"])
        para = lambda mark: f"<{t}>{mark}{prose()}</{t}>"
        shut = f"</{plain[1:].split(' ')[0].rstrip('>')}>" if plain else ""
        lead = "".join(f"<{t}>{link(DROP + said(1, 3))}</{t}>" for _ in range(rnd.randint(0, 6)))
        lead += rnd.choice(["", "", f"<{t}>{DROP}We use cookies {prose()}</{t}>", para(DROP) + f"<{t}>{DROP}Advertisement</{t}>"])
        inside = "".join(para(KEEP) if rnd.random() < 0.85 else f"<h2>{KEEP}{said(1, 6)}</h2>" for _ in range(rnd.randint(1, 12)))
        tail = ""
        for said_by in rnd.sample(["Comments", "Reader comments", "Leave a reply", "Related articles", "Read more", "Subscribe"], rnd.choice([0, 1, 1, 2])):
            level = rnd.choice(["h2", "h3", t])
            tail += f"<{level}>{DROP}{said_by}{rnd.choice(['', '', ' (' + str(rnd.randint(1, 90)) + ')'])}</{level}>" + "".join(para(DROP) for _ in range(rnd.randint(1, 6)))
        tail += rnd.choice(["", f"<{t}>{DROP}© {said(1, 5)}</{t}>"])
        return f"<html><body>{plain}{lead}<h1>{KEEP}{said(1, 10)}</h1>{inside}{tail}{shut}</body></html>"

    main: list[str] = []
    for _ in range(rnd.randint(1, 14)):
        kind = rnd.random()
        if kind < 0.72:
            main.append(rnd.choice(["<p>", "<p>", "<p>", "<p><b>"]) + KEEP + prose() + rnd.choice(["</p>"] * 4 + ["<br>", ""]))
        elif kind < 0.82:
            main.append(f"<h{(k := rnd.randint(2, 4))}>{KEEP}{said(1, 8)}</h{k}>")
        elif kind < 0.88:
            main.append("<ul>" + "".join(f"<li>{KEEP}{prose()}</li>" for _ in range(rnd.randint(1, 5))) + "</ul>")
        elif kind < 0.92:
            main.append(f"<blockquote><p>{KEEP}{prose()}</p></blockquote>")
        elif kind < 0.95:
            main.append("<table>" + "".join(f"<tr><td>{KEEP}{said(1, 4)}</td><td>{KEEP}{said(1, 4)}</td></tr>" for _ in range(rnd.randint(1, 4))) + "</table>")
        elif kind < 0.97:
            main.append(f"<p>{KEEP}{prose()} {link(said(1, 3))} {prose()}</p>")
        elif kind < 0.98:
            main.append(f"<p>{KEEP}{prose()}</p>" * rnd.randint(5, 40))
        else:
            main.append(furniture())
    title = f"<h1>{KEEP}{said(1, 12)}</h1>"
    if rnd.random() < 0.2:
        title = f"<header>{title}</header>"
    inner = title + "".join(main)
    if rnd.random() < 0.15:
        inner += comments()
    tag, cls = rnd.choice([("article", "")] * 5 + [("main", ""), ("div", name("content", "post", "entry-content", "article-body", "story")), ("section", name("content", "post", "article")), ("article", name("post", "entry"))])
    content = f"<{tag}{cls}>{inner}</{tag}>"
    if rnd.random() < 0.3:
        content = f"<main>{content}</main>" if tag != "main" else f"<div id=page>{content}</div>"
    top = [f"<header{rnd.choice(['', name('site-header', 'top', 'masthead')])}><p>{DROP}{said(1, 6)}</p>{menu('nav', rnd.randint(1, 6))}</header>", menu("nav", rnd.randint(2, 9)), menu("div", rnd.randint(2, 9)) if rnd.random() < 0.3 else menu("nav", rnd.randint(2, 6))]
    before = rnd.sample(top, rnd.randint(0, 2)) + [furniture() for _ in range(rnd.choice([0, 1, 1, 2]))]
    after = [furniture() for _ in range(rnd.choice([0, 0, 1, 2]))]
    if rnd.random() < 0.25:
        after.insert(0, comments())
    if rnd.random() < 0.85:
        foot = rnd.choice([f"{DROP}© {word()}.example.com · {prose()}", f"<p>{DROP}© {said(1, 4)}</p><p>{DROP}{prose()}</p>", f"<ul><li>{link(DROP + 'Privacy')}</li><li>{link(DROP + 'Terms')}</li></ul><p>{DROP}Copyright {said(1, 5)}</p>"])
        after.append(f"<footer{rnd.choice(['', name('footer', 'site-footer')])}>{foot}</footer>" if rnd.random() < 0.8 else f"<div{name('footer', 'bottom', 'copyright')}>{foot}</div>")
    return f"<html><head><title>{said(2, 6)}</title></head><body>{''.join(before)}{content}{''.join(after)}</body></html>"


def example(rnd: random.Random, flat: bool = False) -> tuple[list[Block], np.ndarray]:
    """A built page's blocks, without their marks, and their labels."""
    found = blocks(example_page(rnd, flat))
    y = np.array([b.text[0] == KEEP for b in found], np.float32)
    for b in found:
        b.text = re.sub(f"[{KEEP}{DROP}]", "", b.text).strip() or "."
    return found, y


_trained: list[BlockLabeller] = []


def labeller() -> BlockLabeller:
    """The labeller, trained on first use in this process."""
    if not _trained:
        rnd = random.Random(SEED)
        pages = []
        for _ in range(TRAIN_PAGES):
            found, y = example(rnd, rnd.random() < FLAT)
            pages.append((vectors(found), y))
        _trained.append(BlockLabeller().fit(pages))
    return _trained[0]


def main_texts(pages: Iterable[str], model: BlockLabeller) -> list[str]:
    cut = [blocks(p) if p else [] for p in pages]
    return ["\n\n".join(b.text for b, keep in zip(found, kept) if keep) for found, kept in zip(cut, model.label(cut))]


def main_text(pages: DataFrame, key: str = "page_id", column: str = "html", model: BlockLabeller | None = None) -> DataFrame:
    """(key, url, text, n_chars) of every page."""
    weights = pages.sparkSession.sparkContext.broadcast(model or labeller())

    def run(batches):
        for batch in batches:
            for k in range(0, len(batch), 512):
                part = batch.slice(k, 512)
                text = main_texts([x or "" for x in part.column(2).to_pylist()], weights.value)
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(text, pa.string()), pa.array([len(t) for t in text], pa.int64())], names=[key, "url", "text", "n_chars"])

    kind = dict(pages.dtypes)[key]
    return pages.select(key, "url", F.col(column)).mapInArrow(run, f"{key} {kind}, url string, text string, n_chars long")


def op7_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_text(table(spark, sf_dir, "pages"))
