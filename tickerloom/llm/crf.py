"""Main text of web pages by a linear-chain conditional random field.

A page is cut into leaf blocks: runs of text between block-level tags. A block's
features come from its ancestors (tags, and the words of their class, id and role
attributes), from its text and from its place. A chain over the blocks with two
labels, main and other, is trained by gradient ascent on the likelihood
(forward-backward) and decoded by Viterbi.

The labelled pages are a bounded sample of the table's own pages. Where a page
marks its article, its blocks are labelled by that mark; each is also laid out
anew in other common layouts, in which the same blocks keep their labels, so the
model does not lean on one tag.

Defined results: a null page is empty; a page without main blocks gives an empty
text; a table in which no page marks its article trains on what lengths, links and
marks say; malformed and unclosed markup is read as far as it goes; attribute values may
have any length; a self-closed element holds nothing; repeated rows come back
repeated; an empty table gives no rows.
"""

from __future__ import annotations

import html as html_entities
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from functools import reduce

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickerloom.llm.common import map_texts, table, without

FIT_PAGES = 40  # labelled pages, those with the smallest hashes of their ids
FIT_BLOCKS = 80  # blocks of a labelled page that train, half of them its first ones
DEPTH = 512  # of nested elements
SIZE = 1 << 12  # hashed features
STEPS, RATE, PENALTY = 80, 0.4, 2e-4

# HTML element names.
BLOCKS = frozenset(
    "address article aside blockquote body br caption center dd details dialog dir div dl dt "
    "fieldset figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html "
    "legend li main menu nav noframes ol option p pre section select summary table tbody td "
    "template tfoot th thead title tr ul".split())
VOID = frozenset("area base br col embed hr img input link meta source track wbr param".split())
RAW = ("script", "style", "textarea", "title", "noscript", "template", "svg", "iframe", "select")
CLOSES_ITSELF = frozenset("p li dt dd tr td th option".split())

_OPENING = re.compile(
    r"<!--.*?(?:-->|$)|<!\[CDATA\[.*?(?:\]\]>|$)|<[!?][^>]*>?|<(/?)([a-zA-Z][^\s/>\"']*)", re.S)
_SPECIAL = re.compile(r"[>\"']")
_CUT_OFF = re.compile(r"<[a-zA-Z/!][^>]*$")
_ATTRIBUTE = re.compile(r"(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_RAW_END = {tag: re.compile(rf"</{tag}\s*>", re.I) for tag in RAW}
_WORD = re.compile(r"[a-z]+")


@dataclass
class Block:
    """A run of text and what surrounds it."""

    text: str
    path: tuple[str, ...]  # tags from the root
    marks: frozenset  # words of the ancestors' class, id and role
    linked: int = 0  # characters inside links


class TagEnds:
    """Where the tags of a page end, by quotes; each quote is looked at once."""

    def __init__(self, page: str):
        self.page = page
        self.specials = [m.start() for m in _SPECIAL.finditer(page)]
        self.known: dict[int, int] = {}

    def end(self, place: int) -> int:
        """The place of the ``>`` that ends a tag open at ``place``, -1 for none."""
        walked = []
        while True:
            i = bisect_left(self.specials, place)
            if i == len(self.specials):
                end = -1
                break
            special = self.specials[i]
            if special in self.known:
                end = self.known[special]
                break
            walked.append(special)
            if self.page[special] == ">":
                end = special
                break
            closing = self.page.find(self.page[special], special + 1)
            if closing < 0:
                end = -1
                break
            place = closing + 1
        self.known.update(dict.fromkeys(walked, end))
        return end


def tokens(page: str) -> Iterator[tuple[int, int, str | None, str | None, str]]:
    """(start, end, slash, name, attributes) of comments (without name) and tags."""
    ends = TagEnds(page)
    at = 0
    while (found := _OPENING.search(page, at)) is not None:
        name = found.group(2)
        if name is None:
            at = yield found.start(), found.end(), None, None, ""
            continue
        end = ends.end(found.end())
        if end < 0:
            at = found.end()  # no tag: it stays text
            continue
        at = yield (found.start(), end + 1, found.group(1), name.lower(),
                    page[found.end():end])


def blocks(page: str) -> list[Block]:
    """The leaf blocks of a page, in order.

    Elements more than ``DEPTH`` deep are taken as children of the last one that is
    not, as browsers do.
    """
    found: list[Block] = []
    # (tag, tags from the root, words of all marks)
    stack: list[tuple[str, tuple[str, ...], frozenset]] = []
    open_tags: Counter = Counter()
    deeper: Counter = Counter()  # open elements that are too deep for the stack
    parts: list[str] = []
    linked = at = 0

    def close() -> None:
        nonlocal linked
        text = " ".join("".join(parts).split())
        if text:
            _, tags, marks = stack[-1] if stack else ("", (), frozenset())
            found.append(Block(text, tags, marks, min(linked, len(text))))
        parts.clear()
        linked = 0

    def leave() -> str:
        name = stack.pop()[0]
        open_tags[name] -= 1
        return name

    def say(raw: str) -> None:
        nonlocal linked
        if raw:
            text = html_entities.unescape(raw)
            parts.append(text)
            if open_tags["a"]:
                linked += len(text)

    walk = tokens(page)
    token = next(walk, None)
    while token is not None:
        start, end, slash, name, attributes = token
        say(page[at:start])
        at = end
        if name in BLOCKS:
            close()
        if name is None:
            pass
        elif slash:
            if deeper[name]:
                deeper[name] -= 1
            elif open_tags[name]:
                while leave() != name:
                    pass
                deeper.clear()
        elif name in RAW and not attributes.endswith("/"):
            over = _RAW_END[name].search(page, at)
            at = len(page) if over is None else over.end()
        elif name not in VOID and not attributes.endswith("/"):
            if name in CLOSES_ITSELF and stack and stack[-1][0] == name:
                leave()
            if len(stack) >= DEPTH:
                deeper[name] += 1
            else:
                marks = frozenset(w for m in _ATTRIBUTE.finditer(attributes)
                                  for g in m.groups() if g for w in _WORD.findall(g.lower()))
                _, tags, above = stack[-1] if stack else ("", (), frozenset())
                stack.append((name, (*tags, name), above if marks <= above else above | marks))
                open_tags[name] += 1
        try:
            token = walk.send(at)
        except StopIteration:
            token = None
    say(_CUT_OFF.sub("", page[at:]))
    close()
    return found


# Words that pages use in class, id and role for what is not the article, by kind.
_CHROME = {
    "nav": "nav menu navbar navigation breadcrumb breadcrumbs topbar toolbar tabs pager",
    "header": "header masthead banner branding logo",
    "footer": "footer copyright legal bottom contentinfo",
    "aside": "sidebar aside widget related complementary recommended trending popular share "
             "social author tags",
    "ad": "ad ads advert advertisement sponsor sponsored promo banner",
    "notice": "cookie consent notice alert gdpr popup modal overlay newsletter subscribe signup",
    "form": "form search login contact",
    "comments": "comments comment replies reply discussion respond disqus",
}
_CHROME_MARKS = frozenset(w for words in _CHROME.values() for w in words.split())
_MAIN = "content article post entry story main body text"
_ROLES = {kind: frozenset(words.split()) for kind, words in {**_CHROME, "main": _MAIN}.items()}
_TAG_ROLES = {"nav": "nav", "menu": "nav", "header": "header", "footer": "footer",
              "aside": "aside", "form": "form", "main": "main", "article": "main"}


def _bucket(value: float, *bounds: float) -> int:
    return sum(value >= b for b in bounds)


def features(page: list[Block]) -> list[list[str]]:
    """The names of each block's features."""
    out = []
    for i, b in enumerate(page):
        words = len(b.text.split())
        names = {f"tag {t}" for t in b.path[2:]} | {f"mark {m}" for m in b.marks}
        names |= {f"role {kind}" for kind, marks in _ROLES.items() if b.marks & marks}
        names |= {f"role {_TAG_ROLES[t]}" for t in b.path if t in _TAG_ROLES}
        names |= {f"last {' '.join(b.path[-1:])}",
                  f"words {_bucket(words, 2, 4, 8, 15, 30, 60)}",
                  f"linked {_bucket(b.linked / len(b.text), 0.01, 0.3, 0.7, 1)}",
                  f"ends {b.text[-1] in '.!?:;'}",
                  f"sign {'copyright' if b.text[0] == chr(169) else 'none'}",
                  f"first {i == 0}", f"final {i == len(page) - 1}", "any"}
        out.append(sorted(names))
    return out


def _hash(name: str) -> int:
    import zlib

    return zlib.crc32(name.encode()) % SIZE


@dataclass
class Chain:
    """Weights: ``emit`` for (feature, label), ``move`` for label pairs."""

    emit: np.ndarray = field(default_factory=lambda: np.zeros((SIZE, 2)))
    move: np.ndarray = field(default_factory=lambda: np.zeros((2, 2)))

    def __post_init__(self) -> None:
        self._memo: dict = {}

    def potentials(self, rows: list[list[str]]) -> np.ndarray:
        return np.array([self.emit[[_hash(n) for n in names]].sum(0) for names in rows])

    def decode(self, page: list[Block]) -> list[bool]:
        """Viterbi: whether each block is main text, in the likeliest labelling."""
        if not page:
            return []
        memo, move = self._memo, self.move.tolist()
        best, back = (0.0, 0.0), []
        for names in features(page):
            key = tuple(names)
            if key not in memo:
                if len(memo) > 50_000:
                    memo.clear()
                memo[key] = self.emit[[_hash(n) for n in names]].sum(0).tolist()
            other, main = memo[key]
            if not back:
                best = (other, main)
                back.append((0, 0))
                continue
            steps = [(best[0] + move[0][y], best[1] + move[1][y]) for y in (0, 1)]
            back.append(tuple(int(s[1] > s[0]) for s in steps))
            best = (max(steps[0]) + other, max(steps[1]) + main)
        label, labels = int(best[1] > best[0]), []
        for origin in reversed(back):
            labels.append(bool(label))
            label = origin[label]
        return labels[::-1]

    def text(self, page: str) -> str:
        found = blocks(page)
        return " ".join(b.text for b, main in zip(found, self.decode(found)) if main)


def train(pages: list[tuple[list[Block], list[bool]]]) -> Chain:
    """Maximum likelihood with a quadratic penalty, by gradient steps over all pages."""
    chain = Chain()
    pages = [p for p in pages if p[0]]
    if not pages:
        return chain
    rows = [names for page, _ in pages for names in features(page)]
    sizes = [len(page) for page, _ in pages]
    labels = np.array([int(y) for _, ys in pages for y in ys])
    owner = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    place = np.array([_hash(n) for r in rows for n in r])
    starts = np.cumsum([0, *sizes])
    total = len(rows)
    grown = [np.zeros_like(chain.emit), np.zeros_like(chain.move)]
    seen = np.zeros((2, 2))
    for a, b in zip(starts, starts[1:]):
        np.add.at(seen, (labels[a:b - 1], labels[a + 1:b]), 1)
    truth = np.eye(2)[labels]
    for _ in range(STEPS):
        emit = np.stack([np.bincount(owner, chain.emit[place, y], total) for y in (0, 1)], 1)
        belief, moves = np.empty((total, 2)), np.zeros((2, 2))
        for a, b in zip(starts, starts[1:]):
            _forward_backward(emit[a:b], chain.move, belief[a:b], moves)
        error = truth - belief
        slopes = [np.stack([np.bincount(place, error[owner, y], SIZE) for y in (0, 1)], 1),
                  seen - moves]
        for weights, slope, sums in zip((chain.emit, chain.move), slopes, grown):
            slope -= PENALTY * total * weights
            sums += slope ** 2
            weights += RATE * slope / (np.sqrt(sums) + 1e-9)
    return chain


def _forward_backward(emit: np.ndarray, move: np.ndarray, belief: np.ndarray,
                      moves: np.ndarray) -> None:
    """Fills the blocks' marginals and adds the expected label pairs."""
    n = len(emit)
    ahead, behind = np.zeros((n, 2)), np.zeros((n, 2))
    ahead[0] = emit[0]
    for i in range(1, n):
        ahead[i] = emit[i] + np.logaddexp(*(ahead[i - 1][:, None] + move))
        j = n - 1 - i
        behind[j] = np.logaddexp(*(move + emit[j + 1] + behind[j + 1]).T)
    whole = np.logaddexp(*ahead[-1])
    belief[:] = np.exp(ahead + behind - whole)
    pairs = ahead[:-1, :, None] + move + (emit[1:] + behind[1:])[:, None, :] - whole
    moves += np.exp(pairs).sum(0)


def marked(page: str) -> tuple[list[Block], list[bool]]:
    """A page's blocks, labelled by its article element."""
    found = blocks(page)
    return found, ["article" in b.path and not b.marks & _CHROME_MARKS
                   and not _CHROME_TAGS & set(b.path) for b in found]


_CHROME_TAGS = frozenset("nav aside footer form menu button dialog".split())

def layouts(found: list[Block], labels: list[bool], seed: int) -> list[tuple]:
    """The same blocks in other layouts: their texts with new ancestors, labels kept.

    A layout draws a container for the main text, with or without a telling name,
    and puts other blocks into containers of the kinds that pages have around it;
    blocks as long as paragraphs stand there too, as in comments and notices.
    """
    main = [b for b, y in zip(found, labels) if y]
    rest = [b for b, y in zip(found, labels) if not y]
    if not main:
        return []
    made = []
    for turn in range(6):
        draw = np.random.default_rng((seed, turn))

        def pick(options):
            options = options.split() if isinstance(options, str) else options
            return options[int(draw.integers(len(options)))]

        holder = (("html", "body", "main"), ("html", "body", "article"), ("html", "body", "div"),
                  ("html", "body", "main", "article"), ("html", "body", "section"),
                  ("html", "body"))[turn]
        named = turn in (2, 4) or (turn < 5 and draw.random() < 0.4)
        names = frozenset([pick(_MAIN)]) if named and draw.random() < 0.8 else frozenset()

        def chrome(kind):
            tag = {"nav": "nav", "header": "header", "footer": "footer", "aside": "aside",
                   "form": "form"}.get(kind, pick("div section"))
            inner = kind in ("aside", "ad", "comments", "form", "notice") and draw.random() < 0.25
            path = (holder if inner else ("html", "body")) + (tag,)
            if tag == "div" or draw.random() < 0.5:
                marks = frozenset([pick(_CHROME[kind])])
            else:
                marks = frozenset()
            out = []
            for _ in range(int(draw.integers(1, 4))):
                long = kind in ("comments", "notice", "aside", "ad") and draw.random() < 0.6
                b = pick(main if long or not rest else rest)
                link = kind in ("nav", "header") or (kind == "aside" and draw.random() < 0.5)
                leaf = ("ul", "li", "a") if link else ("p",) if long else ()
                if kind == "header" and draw.random() < 0.6:
                    leaf, link = ("h1",), False
                out.append((Block(b.text, path + leaf, marks | (names if inner else frozenset()),
                                  len(b.text) if link else 0), False))
            return out

        leaves = [pick("h1 h1 p"), *(pick("p p p p p h2 li blockquote") for _ in main[1:])]
        own = [(Block(b.text, holder + (leaf,), names, 0), True)
               for b, leaf in zip(main, leaves)]
        middle = int(draw.integers(1, len(own) + 1))
        page = [pair for kind in ("notice", "header", "nav", "ad")
                if draw.random() < 0.8 for pair in chrome(kind)]
        page += own[:middle]
        page += chrome(pick("ad aside form notice")) if draw.random() < 0.5 else []
        page += own[middle:]
        page += [pair for kind in ("aside", "comments", "form", "footer")
                 if draw.random() < 0.8 for pair in chrome(kind)]
        made.append(([b for b, _ in page], [y for _, y in page]))
    return made


def sampled(pages: DataFrame, id: str, html: str, count: int) -> list[str]:
    """The pages with the ``count`` smallest hashes; the hashes are found before the pages."""
    hashed = pages.select(F.xxhash64(F.col(f"`{id}`")).alias("a"),
                          F.xxhash64(F.col(f"`{html}`")).alias("b"), F.col(f"`{html}`").alias("html"))
    low = hashed.select("a", "b").distinct().orderBy("a", "b").limit(count).collect()
    if not low:
        return []
    wanted = reduce(lambda x, y: x | y, [
        (F.col("a") == r["a"]) & (F.col("b") == r["b"]) for r in low])
    chosen = hashed.where(wanted).groupBy("a", "b").agg(F.first("html").alias("html")).collect()
    return [r["html"] for r in sorted(chosen, key=lambda r: (r["a"], r["b"]))]


def told_by_text(page: str) -> tuple[list[Block], list[bool]]:
    """A page's blocks; long ones with few links that no mark speaks against are main."""
    found = blocks(page)
    return found, [len(b.text.split()) >= 12 and 5 * b.linked < len(b.text)
                   and not b.marks & _CHROME_MARKS and not _CHROME_TAGS & set(b.path)
                   for b in found]


def fit(pages: DataFrame, id: str = "page_id", html: str = "html",
        fit_pages: int = FIT_PAGES, fit_blocks: int = FIT_BLOCKS) -> Chain:
    """Trains on at most ``fit_pages`` pages that mark their article.

    Of a page with more than ``fit_blocks`` blocks the first and the last ones train.
    In a table where no page marks its article, pages are labelled by their blocks'
    lengths, links and marks instead.
    """
    page = F.col(f"`{html}`")
    label = marked
    sample = sampled(pages.where(F.lower(page).contains("<article")), id, html, fit_pages)
    if not sample:
        label = told_by_text
        sample = sampled(pages.where(page.isNotNull()), id, html, fit_pages)
    labelled = []
    half = fit_blocks // 2
    for seed, text in enumerate(sample):
        found, labels = label(text)
        if len(found) > fit_blocks:
            found, labels = found[:half] + found[-half:], labels[:half] + labels[-half:]
        labelled += [(found, labels), *layouts(found, labels, seed)]
    return train(labelled)


def main_text(pages: DataFrame, chain: Chain, html: str = "html",
              keep: Iterable[str] | None = None) -> DataFrame:
    """``keep`` (all columns but the html), ``text`` and ``n_chars``."""
    keep = without(pages, [html, "text", "n_chars"]).columns if keep is None else list(keep)

    def rows():
        def work(texts: list[str]) -> dict:
            made = [chain.text(t) for t in texts]
            return {"text": made, "n_chars": [len(t) for t in made]}

        return work

    return map_texts(pages, html, "text string, n_chars long", rows, keep)


def op5_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return main_text(pages, fit(pages), keep=["page_id", "url"])


QUERIES = {"op5_html_extraction": op5_html_extraction}
ORACLES: dict[str, str] = {}
