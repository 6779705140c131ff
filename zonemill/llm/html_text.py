"""Main text of web pages: a linear-chain conditional random field over DOM leaf blocks.

A page is read into leaf blocks: runs of text between block-level tags, with the ancestors
each lies under. Two labels, main text or not, are decoded for the sequence of blocks by
Viterbi, from features of the ancestor tags, of the words in their class, id and role, and
of the text itself. The field is trained on labelled pages.

The given pages carry no labels, so :func:`labelled_pages` builds the training pages: many
layouts of articles amid menus, headers, footers, sidebars, notices, adverts, forms and
reader comments, where every block's label is known from how it was made.

Defined cases: NULL and empty pages give the empty text; markup that is cut off at the end
of a page is dropped, unclosed elements end with their parent; text outside any element is
a block like any other; ``<br>`` and all other white space inside a block become one space;
blocks of scripts, styles, templates, titles and of form controls are never text; a NULL id
is kept; repeated rows are read each; other columns are kept, and clashing ones replaced.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from html import unescape

import numpy as np
from pyspark.sql import DataFrame

from zonemill.llm.common import add_columns

TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*+(?:>|\Z)"
    r"|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:\"[^\"]*+\"|'[^']*+'|[^'\">])*+)>|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)([^>]*+)(?:>|\Z)|</\Z",
    re.DOTALL,
)
ATTRIBUTE = re.compile(r"\b(class|id|role|hidden|aria-hidden)\b(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?", re.IGNORECASE)
TOKEN = re.compile(r"[a-z]+")
# The HTML elements of each kind.
BLOCKS = frozenset(
    "address article aside blockquote body button caption center dd details dialog div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre section "
    "select summary table tbody td textarea tfoot th thead title tr ul".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
ENDLESS = frozenset("script style iframe textarea title".split())
RAW = frozenset("script style noscript template iframe svg textarea title select object canvas".split())
CLOSES_P = BLOCKS - frozenset("body html head option optgroup button".split())
SIBLINGS = {"li": "li", "dt": "dt dd", "dd": "dt dd", "tr": "tr td th", "td": "td th", "th": "td th", "option": "option"}
# Words of class, id and role names, by what such an element holds.
FAMILIES = {
    "menu": "nav navbar navigation menu breadcrumb breadcrumbs toolbar pagination pager skip topbar tabs toc",
    "head": "header masthead banner branding logo sitename tagline",
    "foot": "footer copyright legal colophon contentinfo bottom imprint",
    "side": "sidebar aside side related widget complementary recommended rail trending more popular tags",
    "ad": "ad ads advert advertisement sponsor sponsored promo promoted promotion adslot banner adbox commercial",
    "notice": "cookie cookies consent notice alert popup modal gdpr overlay announcement warning disclaimer message",
    "form": "form login signup signin search subscribe newsletter register poll contact",
    "comment": "comment comments reply replies discussion disqus respond responses feedback reader readers thread",
    "share": "share social sharing follow meta byline author",
    "main": "article content post entry main story body text page prose copy paragraph",
}
FAMILY_OF: dict[str, tuple[str, ...]] = {}
for _family, _words in FAMILIES.items():
    for _word in _words.split():
        FAMILY_OF[_word] = (*FAMILY_OF.get(_word, ()), _family)
ANCESTORS = "article main section div nav header footer aside form ul ol li table p h blockquote pre figure dl button a".split()


@dataclass(frozen=True)
class Block:
    """Text of a leaf, the path it lies under, and how much of it is linked."""

    text: str
    path: tuple[tuple[str, str], ...]
    linked: int


def _names(attributes: str) -> str:
    """The words of class, id and role, and a mark for hidden elements."""
    found = []
    for name, *values in ATTRIBUTE.findall(attributes):
        value = next((v for v in values if v), "").lower()
        if name.lower() in ("hidden", "aria-hidden"):
            found += ["hidden"] if value != "false" else []
        else:
            found += TOKEN.findall(value)
    return " ".join(found)


def leaf_blocks(html: str) -> Iterator[Block]:
    """The leaf blocks of a page in order."""
    stack: list[tuple[str, str]] = []
    parts: list[str] = []
    linked = at = 0
    path: tuple = ()

    def flush() -> Iterator[Block]:
        nonlocal linked
        text = " ".join("".join(parts).split())
        if text:
            yield Block(text, path, min(linked, len(text)))
        parts.clear()
        linked = 0

    def say(text: str) -> None:
        nonlocal path, linked
        if text:
            text = unescape(text) if "&" in text else text
            if not parts or (not path and text.strip()):
                path = tuple(stack)
            elif text.strip() and not "".join(parts).strip():
                path = tuple(stack)
            parts.append(text)
            if any(tag == "a" for tag, _ in stack):
                linked += len(text.strip())

    unclosed: set[str] = set()
    while True:
        match = TAG.search(html, at)
        if match is None:
            say(html[at:])
            break
        say(html[at : match.start()])
        at = match.end()
        close, tag, attributes = match.group(1), match.group(2), match.group(3)
        if tag is None:
            close, tag, attributes = match.group(4), match.group(5), match.group(6)
            if tag is None or not match.group().endswith(">"):
                continue
        tag = tag.lower()
        if tag in RAW and not close:
            yield from flush() if tag in BLOCKS else ()
            if not attributes.endswith("/"):
                end = None if tag in unclosed else re.compile(rf"</{tag}\b[^>]*(?:>|\Z)", re.IGNORECASE).search(html, at)
                # Without an end tag only raw text hides the rest of the page.
                if not end and tag not in ENDLESS:
                    unclosed.add(tag)
                else:
                    at = end.end() if end else len(html)
            continue
        if tag == "br":
            say(" ")
            continue
        if tag in BLOCKS:
            yield from flush()
        if close:
            places = [i for i, (open_tag, _) in enumerate(stack) if open_tag == tag]
            if places:
                del stack[places[-1] :]
            continue
        if tag in CLOSES_P:
            closing = {"p", *SIBLINGS.get(tag, "").split()}
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] in closing:
                    del stack[i:]
                    break
                if stack[i][0] in BLOCKS:
                    break
        if tag not in VOID and not attributes.endswith("/"):
            stack.append((tag, _names(attributes) if attributes else ""))
    yield from flush()


@lru_cache(maxsize=4096)
def path_features(path: tuple[tuple[str, str], ...]) -> tuple[str, ...]:
    """Features of the ancestors: tags, kinds of names, and those of the innermost elements."""
    found = set()
    for depth, (tag, names) in enumerate(reversed(path)):
        kind = "h" if re.fullmatch(r"h[1-6]", tag) else tag
        if kind in ANCESTORS:
            found.add(f"under {kind}")
        for name in names.split():
            if name == "hidden":
                found.add("hidden")
            for family in FAMILY_OF.get(name, ()):
                if not (tag in ("html", "body") and family != "hidden"):
                    found.add(f"named {family}")
                    if depth < 2:
                        found.add(f"near {family}")
    blocks = [tag for tag, _ in path if tag in BLOCKS]
    inner = blocks[-1] if blocks else "none"
    found.add(f"in {'h' if re.fullmatch('h[1-6]', inner) else inner}")
    if "under article" not in found and "under main" not in found:
        found.add("no article")
        if "in h" in found:
            found.add("heading outside")
    return tuple(sorted(found))


def block_features(block: Block, first: bool, last: bool) -> list[str]:
    words = block.text.count(" ") + 1
    share = block.linked / max(1, len(block.text))
    size = 0 if words < 3 else 1 if words < 8 else 2 if words < 20 else 3 if words < 50 else 4
    found = [*path_features(block.path), f"size {size}", f"linked {min(3, int(share * 4))}"]
    if block.text[-1] in ".!?\"'»”…":
        found.append("ends as a sentence")
    if "\N{COPYRIGHT SIGN}" in block.text:
        found.append("copyright")
    if first:
        found.append("first")
    if last:
        found.append("last")
    return found


@dataclass
class Field:
    """Weights of the field: a row per feature and a column per label, and the transitions."""

    rows: dict[str, int]
    weights: np.ndarray
    moves: np.ndarray
    start: np.ndarray

    def decode(self, blocks: list[Block]) -> list[bool]:
        """The best labels of a page's blocks, by Viterbi."""
        if not blocks:
            return []
        gains = []
        for at, block in enumerate(blocks):
            rows = [self.rows[f] for f in block_features(block, at == 0, at == len(blocks) - 1) if f in self.rows]
            gains.append(self.weights[rows].sum(axis=0).tolist())
        (m00, m01), (m10, m11) = self.moves.tolist()
        zero, one = (g + s for g, s in zip(gains[0], self.start.tolist(), strict=True))
        came = []
        for g0, g1 in gains[1:]:
            to0, to1 = (zero + m00, one + m10), (zero + m01, one + m11)
            came.append((to0[1] > to0[0], to1[1] > to1[0]))
            zero, one = max(to0) + g0, max(to1) + g1
        label = one > zero
        labels = [label]
        for back in reversed(came):
            label = back[label]
            labels.append(label)
        return labels[::-1]


def train(pages: list[list[tuple[Block, int]]], rounds: int = 120, ridge: float = 1e-3) -> Field:
    """Conditional likelihood by gradient steps (Adam), all pages at a time, padded to the longest."""
    pages = [p for p in pages if p]
    rows: dict[str, int] = {}
    coded = []
    for page in pages:
        found = [block_features(b, at == 0, at == len(page) - 1) for at, (b, _) in enumerate(page)]
        coded.append([[rows.setdefault(f, len(rows)) for f in features] for features in found])
    count, longest = len(pages), max(map(len, pages))
    x = np.zeros((count, longest, len(rows)), dtype=np.float32)
    y = np.zeros((count, longest), dtype=np.int64)
    live = np.zeros((count, longest), dtype=bool)
    for p, page in enumerate(pages):
        for at, (_, label) in enumerate(page):
            x[p, at, coded[p][at]], y[p, at], live[p, at] = 1, label, True
    w = np.zeros(len(rows) * 2 + 6)
    truth = np.eye(2)[y] * live[:, :, None]
    both = np.zeros((2, 2))
    for a in (0, 1):
        for b in (0, 1):
            both[a, b] = ((y[:, :-1] == a) & (y[:, 1:] == b) & live[:, 1:]).sum()
    mean, square = np.zeros_like(w), np.zeros_like(w)
    for step in range(1, rounds + 1):
        weights, moves, start = w[: -6].reshape(-1, 2), w[-6:-2].reshape(2, 2), w[-2:]
        gain = x @ weights.astype(np.float32)
        ahead = np.zeros((count, longest, 2))
        behind = np.zeros((count, longest, 2))
        ahead[:, 0] = gain[:, 0] + start
        for t in range(1, longest):
            now = np.logaddexp.reduce(ahead[:, t - 1, :, None] + moves, axis=1) + gain[:, t]
            ahead[:, t] = np.where(live[:, t, None], now, ahead[:, t - 1])
        for t in range(longest - 2, -1, -1):
            now = np.logaddexp.reduce(moves + (gain[:, t + 1] + behind[:, t + 1])[:, None, :], axis=2)
            behind[:, t] = np.where(live[:, t + 1, None], now, 0.0)
        total = np.logaddexp.reduce(ahead[:, -1], axis=1)
        share = np.exp(ahead + behind - total[:, None, None]) * live[:, :, None]
        pairs = ahead[:, :-1, :, None] + moves + (gain[:, 1:] + behind[:, 1:])[:, :, None, :] - total[:, None, None, None]
        pairs = (np.exp(np.minimum(pairs, 0)) * live[:, 1:, None, None]).sum(axis=(0, 1))
        difference = (truth - share).astype(np.float32)
        gradient = np.concatenate(
            [
                (x.reshape(-1, len(rows)).T @ difference.reshape(-1, 2)).ravel(),
                (both - pairs).ravel(),
                difference[:, 0].sum(axis=0),
            ]
        ) / count - ridge * w
        mean, square = 0.9 * mean + 0.1 * gradient, 0.999 * square + 0.001 * gradient**2
        w = w + 0.2 * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.999**step)) + 1e-8)
    return Field(rows, w[:-6].reshape(-1, 2), w[-6:-2].reshape(2, 2), w[-2:])


class _Maker:
    """Builds one labelled page: HTML in which a marked text says whether it is main text."""

    KEEP, DROP = "\ue000", "\ue001"

    def __init__(self, random: np.random.Generator):
        self.random = random

    def pick(self, *options: str) -> str:
        return options[int(self.random.integers(len(options)))]

    def chance(self, share: float) -> bool:
        return bool(self.random.random() < share)

    def words(self, low: int, high: int) -> str:
        n = int(self.random.integers(low, high))
        letters = self.random.integers(97, 123, size=(n, 9)).astype(np.uint8)
        sizes = self.random.integers(2, 10, size=n)
        return " ".join(bytes(row[:k]).decode() for row, k in zip(letters, sizes, strict=True)).capitalize()

    def sentence(self, low: int = 5, high: int = 60) -> str:
        return self.words(low, high) + self.pick(".", ".", ".", "!", "?")

    def block(self, tag: str, text: str, keep: bool, attributes: str = "") -> str:
        mark = self.KEEP if keep else self.DROP
        end = f"</{tag}>" if tag not in ("p", "li") or self.chance(0.7) else ""
        return f"<{tag}{attributes}>{mark}{text}{end}"

    def named(self, family: str) -> str:
        name = self.pick(*FAMILIES[family].split())
        name = self.pick(name, name, f"{name}-{self.words(1, 2).lower()}", f"{self.words(1, 2).lower()}-{name}")
        return f' {self.pick("class", "class", "id")}="{name}"'

    def menu(self) -> str:
        items = "".join(
            self.pick("<li>{}</li>", "<li>{}").format(f'<a href="/x">{self.DROP}{self.words(1, 4)}</a>')
            for _ in range(int(self.random.integers(2, 8)))
        )
        return self.pick(f"<nav><ul>{items}</ul></nav>", f"<div{self.named('menu')}><ul>{items}</ul></div>", f"<nav{self.named('menu')}>{items}</nav>")

    def junk(self, kind: str, low: int = 2, high: int = 40) -> str:
        """An element of a kind that is not main text, with one to three texts."""
        texts = "".join(
            self.block(self.pick("p", "div", "p", "li" if kind != "comment" else "p"), self.sentence(low, high), False)
            for _ in range(int(self.random.integers(1, 4)))
        )
        bare = f"{self.DROP}{self.sentence(low, high)}"
        title = self.block(self.pick("h2", "h3", "h4"), self.words(1, 5), False) if self.chance(0.4) else ""
        tag = self.pick("div", "section", "div", "aside" if kind in ("side", "ad") else "div")
        if kind == "foot" and self.chance(0.6):
            return f"<footer>{self.pick(texts, self.DROP + chr(169) + ' ' + self.words(2, 30), bare)}</footer>"
        if kind == "head" and self.chance(0.6):
            return f"<header>{self.block(self.pick('h1', 'div', 'p'), self.words(1, 5), False)}{self.pick('', bare)}</header>"
        if kind == "side" and self.chance(0.6):
            return f"<aside>{title}{self.pick(texts, bare)}</aside>"
        if kind == "form":
            inner = f"<label>{self.DROP}{self.words(1, 8)}</label><input name=q><button>{self.DROP}{self.words(1, 3)}</button>"
            return f"<form{self.pick('', self.named('form'))}>{self.pick('', texts)}{inner}</form>"
        return f"<{tag}{self.named(kind)}>{title}{self.pick(texts, texts, bare)}</{tag}>"

    def article(self) -> str:
        parts = [self.block("h1", self.words(3, 12), True)] if self.chance(0.8) else []
        for _ in range(int(self.random.integers(1, 9))):
            draw = self.random.random()
            if draw < 0.72:
                text = self.sentence(3, 90)
                text = self.pick(text, text, text, f"<b>{text}<br>", f'{text} <a href="/y">{self.words(1, 4)}</a>.', f"<em>{text}</em>")
                parts.append(self.block("p", text, True))
            elif draw < 0.8:
                parts.append(self.block(self.pick("h2", "h3"), self.words(1, 8), True))
            elif draw < 0.86:
                items = "".join(self.block("li", self.sentence(2, 15), True) for _ in range(3))
                parts.append(f"<ul>{items}</ul>")
            elif draw < 0.9:
                parts.append(self.block(self.pick("blockquote", "pre", "div", "td"), self.sentence(3, 40), True))
            else:
                parts.append(self.junk(self.pick("ad", "side", "notice", "form", "share")))
        if self.chance(0.15):
            parts.append(self.junk("comment"))
        inner = "".join(parts)
        layout = self.pick("article", "article", "article", "main", "named", "mainarticle", "bare")
        if layout in ("article", "main"):
            return f"<{layout}{self.pick('', self.named('main'))}>{inner}</{layout}>"
        if layout == "mainarticle":
            return f"<main><article>{inner}</article></main>"
        return f"<div{self.named('main')}>{inner}</div>" if layout == "named" else f"<div>{inner}</div>"

    def page(self) -> str:
        parts = [self.menu()] if self.chance(0.8) else []
        before = [self.junk(k) for k in ("head", "notice", "ad") if self.chance(0.4)]
        after = [self.junk(k) for k in ("side", "comment", "ad", "notice", "form", "comment") if self.chance(0.35)]
        parts = [parts, before] if self.chance(0.5) else [before, parts]
        body = "".join(sum(parts, [])) + self.article() + "".join(after)
        body += self.junk("foot") if self.chance(0.85) else ""
        return f"<html><head><title>{self.words(2, 9)}</title></head><body>{body}</body></html>"


def labelled_pages(count: int = 500, seed: int = 11) -> list[list[tuple[Block, int]]]:
    """Blocks with labels (1: main text) of generated pages."""
    maker = _Maker(np.random.default_rng(seed))
    pages = []
    for _ in range(count):
        page = []
        for block in leaf_blocks(maker.page()):
            keep = maker.KEEP in block.text
            text = block.text.replace(maker.KEEP, "").replace(maker.DROP, "").strip()
            if text:
                page.append((Block(text, block.path, min(block.linked, len(text))), int(keep)))
        pages.append(page)
    return pages


def fit() -> Field:
    return train(labelled_pages())


def main_text(html: str | None, field: Field) -> str:
    """The kept blocks in page order, two line feeds between them."""
    blocks = list(leaf_blocks(html or ""))
    return "\n\n".join(b.text for b, keep in zip(blocks, field.decode(blocks), strict=True) if keep)


def extract(pages: DataFrame, field: Field, html_col: str = "html", keep: list[str] | None = None) -> DataFrame:
    """Add ``text`` and ``n_chars`` (code points)."""

    def make():
        def work(htmls: list[str | None]) -> tuple[list[str], list[int]]:
            texts = [main_text(h, field) for h in htmls]
            return texts, [len(t) for t in texts]

        return work

    return add_columns(pages, [html_col], "text string, n_chars long", make, keep)
