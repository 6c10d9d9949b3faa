"""Main text of web pages by a bidirectional LSTM over the page's blocks, in numpy.

A page becomes a sequence of leaf blocks: text between block-level tags, white space folded, character references decoded.
A block is read as a hashed vector of its tag path (tags, classes, ids and roles of all open elements), a hashed vector of
its words, and a few densities. One LSTM reads the sequence forwards and one backwards, so each block is labelled
in the context of the whole page. The network is trained here, by back-propagation through time, on invented pages whose
parts are known: articles with menus, headers, footers, sidebars, notices, adverts, forms and reader comments around
and inside them.
"""

from __future__ import annotations

import html
import random
import re
import zlib
from functools import lru_cache
from itertools import chain

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, FloatType, StringType, StructField, StructType

from .common import add_columns

HASHED = 64
PATHS = 128
DENSITIES = 6
INPUTS = PATHS + HASHED + DENSITIES
HIDDEN = 16
TRAINING_PAGES = 2000
EPOCHS = 18
BATCH = 40
SEED = 11
#: Blocks times pages that one pass of the network holds; longer pages pass alone.
CELLS = 60_000
CACHED_WORDS = 200_000

BLOCKS = frozenset(
    "address article aside blockquote body button caption center dd details dialog div dl dt fieldset figcaption figure footer form frameset"
    " h1 h2 h3 h4 h5 h6 head header hgroup hr html label legend li main menu nav ol option p pre section select summary table tbody td tfoot th"
    " thead tr ul".split()
)
#: Their content is no text of the page.
SILENT = frozenset("script style noscript template iframe textarea title svg object canvas audio video".split())
#: Of these, the tags whose content browsers read as text: they cannot be closed in the opening tag, and unclosed hold the rest.
RAW = frozenset("script style textarea title iframe".split())
EMPTY = frozenset("br hr img input meta link wbr source area base col embed track param".split())
#: An opening tag of the first kind ends an open one of the second.
ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}

_TAG = re.compile(r"<(/?)([A-Za-z][^\s/>]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>")
_CLOSING = {tag: re.compile(rf"</{tag}(?![^\s/>])", re.I | re.A) for tag in SILENT}
_NAMES = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_SPLIT_NAME = re.compile(r"[^\W_]+")
_WORD = re.compile(r"[^\W_]+")
_DIGITS = re.compile(r"\d")
_MARKS = re.compile(r"[.,;:!?…]")


@lru_cache(maxsize=100_000)
def _place(token: str) -> tuple[int, float]:
    code = zlib.crc32(token.encode())
    return code % PATHS, 1.0 if code & 0x10000 else -1.0


class _Codes(dict):
    """Signed places of words, counted from one; up to CACHED_WORDS are remembered."""

    def __missing__(self, word: str) -> int:
        at, sign = _place(word[:12].lower())
        at %= HASHED
        if len(self) >= CACHED_WORDS:
            self.clear()
        self[word] = code = int(sign) * (at + 1)
        return code


_codes = _Codes()


def _path_vector(parent: np.ndarray | None, tag: str, names: list[str]) -> np.ndarray:
    vector = np.zeros(PATHS, np.float32) if parent is None else parent.copy()
    for token in (tag, *(f".{n}" for n in names)):
        at, sign = _place(token)
        vector[at] += sign
    return vector


class Block:
    __slots__ = ("path", "tag", "text", "linked")

    def __init__(self, path: np.ndarray, tag: str, text: str, linked: int) -> None:
        self.path, self.tag, self.text, self.linked = path, tag, text, linked


def blocks_of(page: str) -> list[Block]:
    """The leaf blocks of a page in order, without empty ones; bad markup is read as browsers do, roughly."""
    root = _path_vector(None, "", [])
    stack: list[tuple[str, np.ndarray]] = [("", root)]
    open_at: dict[str, list[int]] = {}  # of each tag: the places of its open elements in the stack
    found: list[Block] = []
    parts: list[str] = []
    linked = links = 0

    def flush() -> None:
        nonlocal linked
        if parts:
            text = " ".join(html.unescape("".join(parts)).split())
            if text:
                found.append(Block(stack[-1][1], stack[-1][0], text, linked))
            parts.clear()
        linked = 0

    at, size = 0, len(page)
    ends: dict[str, int] = {}  # of silent tags: where the next closing one begins, or the page's size
    while at < size:
        begin = page.find("<", at)
        if begin < 0:
            begin = size
        if begin > at:
            parts.append(page[at:begin])
            if links:
                linked += begin - at
        if begin == size:
            break
        after = page[begin + 1 : begin + 2]
        if page.startswith("<!--", begin):
            end = page.find("-->", begin + 4)
            at = size if end < 0 else end + 3
            continue
        if not (after.isascii() and after.isalpha() or after and after in "/!?"):
            parts.append("<")
            at = begin + 1
            continue
        end = page.find(">", begin)
        if end < 0:
            break  # a tag cut off by the end of the page
        m = _TAG.match(page, begin)
        if not m:
            at = end + 1
            continue
        at = m.end()
        closing, tag = m[1], m[2].lower()
        if tag in SILENT and not closing:
            if tag not in RAW and m[3].endswith("/"):
                continue
            if ends.get(tag, -1) < at:
                found_end = _CLOSING[tag].search(page, at)
                ends[tag] = found_end.start() if found_end else size
            if ends[tag] < size or tag in RAW:
                at = ends[tag]
            continue
        if tag == "a":
            links = 0 if closing else 1
        elif tag == "br":
            parts.append(" ")
        if tag not in BLOCKS:
            continue
        flush()
        if closing:
            depth = open_at[tag][-1] if open_at.get(tag) else len(stack)
            while len(stack) > depth:
                open_at[stack.pop()[0]].pop()
            continue
        if stack[-1][0] == "p" or stack[-1][0] in ENDS.get(tag, ()):
            open_at[stack.pop()[0]].pop()
        if tag not in EMPTY:
            attributes = [a or b or c for _, a, b, c in _NAMES.findall(m[3])] if "=" in m[3] else []
            names = [w.lower() for value in attributes for w in _SPLIT_NAME.findall(value)]
            open_at.setdefault(tag, []).append(len(stack))
            stack.append((tag, _path_vector(stack[-1][1], tag, names)))
    flush()
    return found


def features(found: list[Block]) -> np.ndarray:
    count = len(found)
    if not count:
        return np.zeros((0, INPUTS), np.float32)
    words = [_WORD.findall(b.text) for b in found]
    sizes = np.array([len(w) for w in words])
    codes = np.fromiter(map(_codes.__getitem__, chain.from_iterable(words)), np.int64, sizes.sum())
    cells = np.repeat(np.arange(count) * HASHED, sizes) + np.abs(codes) - 1
    hashed = np.bincount(cells, np.sign(codes), count * HASHED).reshape(count, HASHED)
    paths = np.clip(np.stack([b.path for b in found]), -2, 2)
    for i, block in enumerate(found):
        at, sign = _place(f"leaf:{block.tag}")
        paths[i, at] += 2 * sign
    lengths = np.array([len(b.text) for b in found])
    order = np.arange(1, count + 1)
    densities = (
        np.log1p(lengths) / 6,
        np.minimum(1.0, np.array([b.linked for b in found]) / lengths),
        np.minimum(1.0, 10 * np.array([len(_MARKS.findall(b.text)) for b in found]) / lengths),
        np.minimum(1.0, 5 * np.array([len(_DIGITS.findall(b.text)) for b in found]) / lengths),
        order / count,
        1 / order,
    )
    # However often a block repeats a word, it weighs no more than in a block of its own.
    words_seen = np.clip(hashed / (4 * np.sqrt(np.maximum(1, sizes)))[:, None], -0.25, 0.25)
    return np.concatenate([paths, words_seen, np.stack(densities, axis=1)], axis=1).astype(np.float32)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-x))


class BlockLabeller:
    """Two LSTMs of HIDDEN cells and an output over both; weights are plain arrays."""

    def __init__(self, weights: dict[str, np.ndarray]) -> None:
        self.w = weights

    @classmethod
    def random(cls, rng: np.random.Generator) -> BlockLabeller:
        w = {"out": np.zeros(2 * HIDDEN + 1)}
        for side in ("ahead", "back"):
            w[f"{side}_x"] = rng.normal(0, 0.2, (INPUTS, 4 * HIDDEN))
            w[f"{side}_h"] = rng.normal(0, 0.2, (HIDDEN, 4 * HIDDEN))
            bias = np.zeros(4 * HIDDEN)
            bias[HIDDEN : 2 * HIDDEN] = 1.0
            w[f"{side}_b"] = bias
        w["out"][:-1] = rng.normal(0, 0.2, 2 * HIDDEN)
        return cls(w)

    def _run(self, side: str, x: np.ndarray, real: np.ndarray, memory: list | None) -> np.ndarray:
        """States (time, pages, HIDDEN); steps that are not real keep the state, so padding has no effect."""
        steps, pages, _ = x.shape
        given = x @ self.w[f"{side}_x"] + self.w[f"{side}_b"]
        recur = self.w[f"{side}_h"]
        h = np.zeros((pages, HIDDEN))
        c = np.zeros((pages, HIDDEN))
        out = np.empty((steps, pages, HIDDEN))
        for t in range(steps) if side == "ahead" else range(steps - 1, -1, -1):
            gates = given[t] + h @ recur
            gates[:, : 3 * HIDDEN] = _sigmoid(gates[:, : 3 * HIDDEN])
            i, f, o, g = np.split(gates, 4, axis=1)
            g = np.tanh(g)
            new = f * c + i * g
            shown = np.tanh(new)
            mask = real[t][:, None]
            if memory is not None:
                memory.append((t, h, c, i, f, o, g, shown, mask))
            c = np.where(mask, new, c)
            h = np.where(mask, o * shown, h)
            out[t] = h
        return out

    def probabilities(self, pages: list[np.ndarray]) -> list[np.ndarray]:
        """Of each block of each page being main text. Pages of like length pass together."""
        result: list[np.ndarray] = [np.zeros(0)] * len(pages)
        order = sorted((i for i, p in enumerate(pages) if len(p)), key=lambda i: len(pages[i]))
        while order:
            longest = len(pages[order[-1]])
            take = max(1, CELLS // longest)
            group, order = order[-take:], order[:-take]
            x, real = _padded([pages[i] for i in group])
            both = np.concatenate([self._run("ahead", x, real, None), self._run("back", x, real, None)], axis=2)
            p = _sigmoid(both @ self.w["out"][:-1] + self.w["out"][-1])
            for k, i in enumerate(group):
                result[i] = p[: len(pages[i]), k]
        return result

    def slopes(self, x: np.ndarray, real: np.ndarray, y: np.ndarray) -> tuple[dict[str, np.ndarray], float]:
        """Gradient of the mean log loss by back-propagation through time."""
        memory: dict[str, list] = {"ahead": [], "back": []}
        both = np.concatenate([self._run(s, x, real, memory[s]) for s in ("ahead", "back")], axis=2)
        p = _sigmoid(both @ self.w["out"][:-1] + self.w["out"][-1])
        n = real.sum()
        error = np.where(real, p - y, 0) / n
        loss = -np.sum(real * (y * np.log(p + 1e-9) + (1 - y) * np.log(1 - p + 1e-9))) / n
        out = {"out": np.append(np.einsum("tp,tph->h", error, both), error.sum())}
        for k, side in enumerate(("ahead", "back")):
            to_h = error[..., None] * self.w["out"][k * HIDDEN : (k + 1) * HIDDEN]
            recur = self.w[f"{side}_h"]
            d_given = np.zeros((*x.shape[:2], 4 * HIDDEN))
            d_recur = np.zeros_like(recur)
            dh = np.zeros((x.shape[1], HIDDEN))
            dc = np.zeros_like(dh)
            for t, h, c, i, f, o, g, shown, mask in reversed(memory[side]):
                dh = dh + to_h[t]
                live_h, live_c = np.where(mask, dh, 0), np.where(mask, dc, 0)
                d_new = live_c + live_h * o * (1 - shown**2)
                gates = np.concatenate([d_new * g * i * (1 - i), d_new * c * f * (1 - f), live_h * shown * o * (1 - o), d_new * i * (1 - g**2)], axis=1)
                d_given[t] = gates
                d_recur += h.T @ gates
                dh = np.where(mask, 0, dh) + gates @ recur.T
                dc = np.where(mask, d_new * f, dc)
            out[f"{side}_x"] = np.tensordot(x, d_given, axes=([0, 1], [0, 1]))
            out[f"{side}_h"] = d_recur
            out[f"{side}_b"] = d_given.sum(axis=(0, 1))
        return out, float(loss)


def _padded(pages: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    longest = max(map(len, pages))
    x = np.zeros((longest, len(pages), INPUTS), np.float32)
    real = np.zeros((longest, len(pages)), bool)
    for k, page in enumerate(pages):
        x[: len(page), k] = page
        real[: len(page), k] = True
    return x, real


class PageMaker:
    """Invented pages with known main text: parts, nesting, names and faults vary."""

    MENU = "home login search sign about contact help news shop more next".split()
    LEGAL = "copyright rights reserved privacy terms imprint policy contact".split()
    NOTICE = "cookies accept consent settings subscribe newsletter agree we use".split()
    ADVERT = "sponsored advert offer buy now save free sale click".split()
    #: An invented name stands for "?".
    ROOMS = (
        ("article", ""), ("article", "post"), ("article", "?"), ("main", ""), ("main", "?"), ("div", "content"), ("div", "main content"),
        ("section", "story"), ("div", "entry content"), ("div", "article body"), ("div", "post"), ("div", "text"), ("div", "?"), ("div", "?"),
        ("section", "?"), ("div", ""), ("section", ""), ("table", ""),
    )

    def __init__(self, seed: int) -> None:
        self.rng = random.Random(seed)
        self.parts: list[str] = []
        self.labels: list[int] = []

    def word(self) -> str:
        r = self.rng
        return "".join(r.choice("bcdfghlmnprst") + r.choice(["a", "e", "i", "o", "u", "ei", "é", "ö"]) + r.choice(["", "n", "r", "s"]) for _ in range(r.randint(1, 4)))

    def words(self, low: int, high: int, extra: list[str] | None = None) -> str:
        r = self.rng
        out = [r.choice(extra) if extra and r.random() < 0.4 else self.word() for _ in range(r.randint(low, high))]
        for i in range(len(out)):
            if r.random() < 0.12:
                out[i] += r.choice([".", ",", ".", "…", "&amp;", "!", "?", ";"])
        return " ".join(out).capitalize() + r.choice([".", ".", ""])

    def put(self, label: int, tag: str, text: str, close: bool = True) -> None:
        self.parts.append(f"<{tag}>{text}" + (f"</{tag.split()[0]}>" if close else ""))
        self.labels.append(label)

    def named(self, tag: str, *names: str) -> str:
        name = self.rng.choice(names)
        if name and self.rng.random() < 0.2:
            name = self.rng.choice([f"{self.word()}-{name}", f"{name} {self.word()}"])
        return f'{tag} {self.rng.choice(["class", "class", "id"])}="{name}"' if name else tag

    def box(self, tag: str, inside) -> None:
        self.parts.append(f"<{tag}>")
        inside()
        if self.rng.random() < 0.97:
            self.parts.append(f"</{tag.split()[0]}>")

    def links(self, most: int) -> None:
        def items() -> None:
            for _ in range(self.rng.randint(1, most)):
                self.put(0, "li", f'<a href="/{self.word()}">{self.words(1, 3, self.MENU)}</a>')

        self.box("ul", items)

    def menu(self) -> None:
        tag = self.rng.choice(["nav", self.named(self.rng.choice(["div", "ul", "td"]), "menu", "nav", "navigation", "navbar", "breadcrumbs", "tabs", "links", "toolbar"), self.named("nav", "top", "main-menu")])
        self.box(tag, lambda: self.links(8))

    def head(self) -> None:
        self.box(self.rng.choice(["header", self.named("div", "header", "site-header", "top-bar", "masthead", "logo", "topbar")]), lambda: (self.put(0, self.rng.choice(["div", "p", "h2"]), self.words(1, 6)), self.rng.random() < 0.5 and self.links(5)))

    def foot(self) -> None:
        def inside() -> None:
            self.parts.append(f"&copy; {self.word()}.example &middot; {self.words(2, 25, self.LEGAL)}")
            self.labels.append(0)
            if self.rng.random() < 0.3:
                self.links(4)

        self.box(self.rng.choice(["footer", "footer", self.named("div", "footer", "site-footer", "bottom", "legal", "copyright", "colophon")]), inside)

    def advert(self) -> None:
        self.put(0, self.named("div", "ad", "ads", "advert", "advertisement", "adbox", "banner", "sponsored", "promo"), self.words(2, 30, self.ADVERT if self.rng.random() < 0.4 else None))

    def notice(self) -> None:
        tag = self.named("div", "cookie", "cookie-notice", "notice", "consent", "gdpr", "alert", "popup", "modal", "overlay", "newsletter", "disclaimer")
        self.box(tag, lambda: (self.put(0, "p", self.words(4, 30, self.NOTICE)), self.rng.random() < 0.5 and self.put(0, "button", self.words(1, 2, self.NOTICE))))

    def side(self) -> None:
        tag = self.rng.choice(["aside", "aside", self.named(self.rng.choice(["div", "aside", "section"]), "promo", "sidebar", "related", "widget", "side", "recommended", "rail", "trending", "share", "tags")])
        self.box(tag, lambda: (self.put(0, "h3", self.words(1, 4)), self.links(6) if self.rng.random() < 0.6 else self.put(0, "p", self.words(5, 40))))

    def form(self) -> None:
        self.box("form", lambda: (self.put(0, "label", self.words(1, 4, self.NOTICE)), self.parts.append('<input name="q">'), self.put(0, "button", self.words(1, 2, self.MENU))))

    def comments(self) -> None:
        r = self.rng
        names = ("comments", "comment-list", "disqus", "reader-comments", "responses", "discussion", "replies")
        tag = self.named(r.choice(["section", "div", "div", "ol"]), *names)
        single = r.choice(["div", "div", "li", "article"])

        def reply(deep: int) -> None:
            self.put(0, r.choice(["p", "p", "div"]), self.words(4, 60))
            if deep and r.random() < 0.3:
                self.box(self.named("div", "comment", "reply", "replies", ""), lambda: reply(deep - 1))

        def inside() -> None:
            if r.random() < 0.8:
                self.put(0, r.choice(["h2", "h3"]), self.words(1, 3))
            closed = r.random() < 0.85
            for _ in range(r.randint(1, 6)):
                box = self.named(single, "comment", "reply", "response", "")
                self.parts.append(f"<{box}>")
                reply(4)
                self.parts.append(f"</{single}>" if closed else "")

        self.box(tag, inside)

    def passage(self) -> None:
        """A part of an article."""
        r = self.rng
        kind = r.random()
        if kind < 0.6:
            text = self.words(1, r.choice([4, 12, 40, 90]))
            if r.random() < 0.03:
                text = " ".join([self.word()] * r.randint(5, 120))
            if r.random() < 0.15:
                text = f"<{(t := r.choice(['b', 'em', 'strong', 'a href=x']))}>{self.words(1, 4)}</{t.split()[0]}> {text}"
            self.put(1, r.choice(["p", "p", "p", "p", "div"]), text, close=r.random() < 0.85)
            if r.random() < 0.05:
                self.parts.append("<noscript>x</noscript>")
        elif kind < 0.66:
            self.put(1, r.choice(["h2", "h3", "h4"]), self.words(1, 8))
        elif kind < 0.73:
            self.box(r.choice(["ul", "ol"]), lambda: [self.put(1, "li", self.words(1, 15)) for _ in range(r.randint(1, 6))])
        elif kind < 0.76:
            self.box("dl", lambda: [self.put(1, t, self.words(1, 12)) for _ in range(r.randint(1, 4)) for t in ("dt", "dd")])
        elif kind < 0.81:
            self.put(1, r.choice(["blockquote", "pre", "figcaption"]), self.words(3, 30))
        elif kind < 0.85:
            self.box("table", lambda: [self.put(1, r.choice(["td", "td", "th"]), self.words(1, 5)) for _ in range(r.randint(1, 6))])
        elif kind < 0.89:
            self.box(r.choice(["div", "section", f"div class={self.word()}"]), lambda: [self.passage() for _ in range(r.randint(1, 3))])
        else:
            r.choice([self.advert, self.advert, self.side, self.form, self.notice])()

    def story(self) -> None:
        r = self.rng
        title = self.words(1, 12)
        if r.random() < 0.92:
            self.put(1, r.choice(["h1", "h1", "h1", "h2"]), title)
        if r.random() < 0.3:
            lead = title if r.random() < 0.5 else self.words(3, 30)
            self.put(1, "p", f"<{(t := r.choice(['b', 'strong', 'em']))}>{lead}" + r.choice(["<br>", f"</{t}>"]), close=r.random() < 0.6)
        for _ in range(r.choice([0, 1, 1, 2, 3, 4, 8, 14])):
            self.passage()

    def page(self) -> tuple[str, list[int]]:
        r = self.rng
        self.parts, self.labels = ['<!DOCTYPE html><html><head><meta charset="utf-8"><title>x</title><style>p{}</style></head><body>'], []
        for part in (self.notice, self.head, self.menu, self.advert, self.side):
            if r.random() < (0.75 if part in (self.menu, self.advert) else 0.35):
                part()
        tag, name = r.choice(self.ROOMS)
        name = name.replace("?", self.word())
        room = f'{tag} {r.choice(["class", "class", "id"])}="{name}"' if name else tag
        inner = ["tr", "td"] if tag == "table" else ["div"] * r.choice([0, 0, 0, 1, 2])
        around = [r.choice(['div class="wrapper"', 'div id="page"', "div", f'div class="{self.word()}"']) for _ in range(r.choice([0, 0, 1, 1, 2, 4]))]
        self.parts += [f"<{t}>" for t in around]
        self.parts.append(f"<{room}>")
        self.parts += [f"<{t}>" for t in inner]
        self.story()
        self.parts += [f"</{t}>" for t in reversed(inner)]
        self.parts.append(f"</{tag}>" if r.random() < 0.97 else "")
        self.parts += ["</div>" for _ in around]
        for part in (self.advert, self.side, self.comments, self.form, self.foot):
            if r.random() < (0.9 if part == self.foot else 0.3):
                part()
        self.parts.append("</body></html>" if r.random() < 0.9 else "")
        return "".join(self.parts), self.labels


@lru_cache(maxsize=2)
def trained(seed: int = SEED) -> BlockLabeller:
    """The network after EPOCHS passes over TRAINING_PAGES invented pages (Adam); the same for the same seed."""
    maker, rng = PageMaker(seed), np.random.default_rng(seed)
    pages: list[tuple[np.ndarray, np.ndarray]] = []
    while len(pages) < TRAINING_PAGES:
        page, labels = maker.page()
        found = blocks_of(page)
        if len(found) == len(labels) <= 80:
            pages.append((features(found), np.array(labels, float)))
    pages.sort(key=lambda p: len(p[0]))
    batches = []
    for low in range(0, len(pages), BATCH):
        group = pages[low : low + BATCH]
        x, real = _padded([p for p, _ in group])
        y = np.zeros(real.shape)
        for k, (_, labels) in enumerate(group):
            y[: len(labels), k] = labels
        batches.append((x.astype(float), real, y))
    model = BlockLabeller.random(rng)
    first = {k: np.zeros_like(v) for k, v in model.w.items()}
    second = {k: np.zeros_like(v) for k, v in model.w.items()}
    step = 0
    for _ in range(EPOCHS):
        for b in rng.permutation(len(batches)):
            slopes, _ = model.slopes(*batches[b])
            step += 1
            rate = 0.02 * (1 - (step - 1) / (EPOCHS * len(batches)))
            for k, slope in slopes.items():
                first[k] = 0.9 * first[k] + 0.1 * slope
                second[k] = 0.99 * second[k] + 0.01 * slope**2
                model.w[k] -= rate * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.99**step)) + 1e-8)
    return model


BLOCK = StructType([StructField("text", StringType()), StructField("probability", FloatType())])


def extract_main_text(pages: DataFrame, source: str = "html", seed: int = SEED) -> DataFrame:
    """``pages`` with ``text``, the main text, and ``blocks``, all blocks with their probability of being main text.

    Blocks at a half or more are joined in page order by line feeds. Null and empty pages, and pages without main
    text, give an empty string; pages of any length are read whole; rows are independent, so repeated rows and nulls
    elsewhere change nothing; an empty frame gives an empty frame. Columns of these names are replaced.
    """
    shared = pages.sparkSession.sparkContext.broadcast(trained(seed).w)

    def start():
        model = BlockLabeller(shared.value)

        def compute(texts: list[str]) -> list[list]:
            found = [blocks_of(t) for t in texts]
            chances = model.probabilities([features(f) for f in found])
            main = ["\n".join(b.text for b, p in zip(f, c, strict=True) if p >= 0.5) if f else "" for f, c in zip(found, chances, strict=True)]
            blocks = [[{"text": b.text, "probability": float(p)} for b, p in zip(f, c, strict=True)] if f else [] for f, c in zip(found, chances, strict=True)]
            return [main, blocks]

        return compute

    made = StructType([StructField("text", StringType()), StructField("blocks", ArrayType(BLOCK))])
    return add_columns(pages, source, made, start)


def main_texts(pages: DataFrame) -> DataFrame:
    found = extract_main_text(pages.select("page_id", "url", "html"))
    return found.select("page_id", "url", "text", F.length("text").cast("bigint").alias("n_chars"))
