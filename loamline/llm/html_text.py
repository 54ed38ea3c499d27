"""Main text of web pages from flat blocks.

A page is cut into flat text blocks at its block-level tags. Each block has a few features: words
and link density of its own and of its neighbours, and where it stands (inside a main region,
inside a menu, advert or other boilerplate container, heading, list item). A decision tree, grown
on the small labelled table below, tells article text from the rest. Every page is handled alone in
its task, so nothing is shuffled.
"""

from __future__ import annotations

import html
import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from loamline.llm.tables import slices

FEATURES = (
    "words", "link_density", "prev_words", "prev_density", "next_words", "next_density",
    "main", "boiler", "heading", "item",
)

# Labelled blocks: the features in the order above (main: 1 inside the page's main region, 0 the
# page has none, -1 outside of it), then 1 for article text and 0 for the rest.
LABELLED = (
    (62, 0.00, 8, 0.0, 55, 0.0, 1, 0, 0, 0, 1),
    (140, 0.05, 60, 0.0, 30, 0.1, 1, 0, 0, 0, 1),
    (1, 0.00, 40, 0.0, 35, 0.0, 1, 0, 0, 0, 1),
    (2, 0.00, 1, 1.0, 0, 0.0, 1, 0, 0, 0, 1),
    (8, 0.00, 3, 1.0, 62, 0.0, 1, 0, 1, 0, 1),
    (3, 1.00, 70, 0.0, 50, 0.0, 1, 0, 0, 0, 1),
    (9, 0.20, 30, 0.0, 12, 0.0, 1, 0, 0, 1, 1),
    (4, 1.00, 25, 0.0, 18, 0.1, 1, 0, 0, 1, 1),
    (5, 1.00, 0, 0.0, 9, 0.0, 1, 0, 1, 0, 1),
    (33, 0.90, 20, 0.0, 10, 0.0, 1, 0, 0, 0, 1),
    (12, 0.00, 2, 1.0, 80, 0.0, 1, 1, 0, 0, 0),
    (75, 0.00, 60, 0.0, 44, 0.0, 1, 1, 0, 0, 0),
    (3, 1.00, 50, 0.0, 3, 1.0, 1, 1, 0, 1, 0),
    (6, 0.00, 3, 0.0, 90, 0.0, 1, 1, 1, 0, 0),
    (20, 0.10, 5, 0.0, 0, 0.0, 1, 1, 0, 1, 0),
    (1, 1.00, 0, 0.0, 1, 1.0, -1, 1, 0, 1, 0),
    (14, 0.00, 1, 1.0, 8, 0.0, -1, 1, 0, 0, 0),
    (90, 0.00, 12, 0.0, 8, 0.0, -1, 1, 0, 0, 0),
    (11, 0.00, 45, 0.0, 0, 0.0, -1, 1, 0, 0, 0),
    (5, 0.00, 0, 0.0, 3, 1.0, -1, 0, 0, 0, 0),
    (48, 0.02, 2, 1.0, 8, 0.0, -1, 0, 0, 0, 0),
    (7, 0.00, 60, 0.0, 0, 0.0, -1, 0, 1, 0, 0),
    (4, 1.00, 5, 1.0, 4, 1.0, -1, 0, 0, 1, 0),
    (70, 0.00, 9, 0.0, 65, 0.0, 0, 0, 0, 0, 1),
    (24, 0.10, 70, 0.0, 40, 0.0, 0, 0, 0, 0, 1),
    (12, 0.00, 55, 0.0, 48, 0.0, 0, 0, 0, 0, 1),
    (4, 0.00, 66, 0.0, 58, 0.0, 0, 0, 0, 0, 1),
    (6, 0.00, 3, 1.0, 52, 0.0, 0, 0, 1, 0, 1),
    (9, 0.00, 40, 0.0, 37, 0.0, 0, 0, 1, 0, 1),
    (18, 0.00, 6, 0.0, 22, 0.0, 0, 0, 0, 0, 1),
    (16, 0.00, 30, 0.1, 15, 0.0, 0, 0, 0, 1, 1),
    (45, 0.20, 2, 1.0, 3, 1.0, 0, 0, 0, 0, 1),
    (2, 1.00, 2, 1.0, 2, 1.0, 0, 0, 0, 1, 0),
    (1, 1.00, 1, 1.0, 20, 0.0, 0, 0, 0, 1, 0),
    (1, 1.00, 24, 0.0, 1, 1.0, 0, 0, 0, 1, 0),
    (2, 1.00, 3, 1.0, 70, 0.0, 0, 0, 0, 0, 0),
    (3, 1.00, 80, 0.0, 0, 0.0, 0, 0, 0, 0, 0),
    (3, 1.00, 0, 0.0, 4, 1.0, 0, 0, 0, 0, 0),
    (5, 0.80, 40, 0.0, 3, 1.0, 0, 0, 0, 0, 0),
    (21, 0.90, 14, 0.8, 17, 0.9, 0, 0, 0, 0, 0),
    (30, 0.70, 9, 1.0, 8, 1.0, 0, 0, 0, 1, 0),
    (4, 0.00, 2, 1.0, 3, 1.0, 0, 0, 0, 0, 0),
    (6, 0.00, 3, 0.0, 4, 0.0, 0, 0, 0, 0, 0),
    (3, 0.00, 4, 1.0, 2, 1.0, 0, 0, 1, 0, 0),
    (60, 0.00, 30, 0.0, 20, 0.0, 0, 1, 0, 0, 0),
    (15, 0.00, 12, 0.0, 80, 0.0, 0, 1, 0, 0, 0),
    (2, 1.00, 3, 1.0, 70, 0.0, 0, 1, 0, 1, 0),
    (5, 0.00, 90, 0.0, 14, 0.0, 0, 1, 1, 0, 0),
    (28, 0.00, 5, 0.0, 33, 0.0, 0, 1, 0, 1, 0),
)

_BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption "
    "figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p "
    "pre search section summary table tbody td tfoot th thead title tr ul".split()
)
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
# Elements whose content is no markup; other embedded ones nest, and end where a block begins or their parent ends.
_RAW = frozenset("script style noscript template textarea title iframe".split())
_EMBEDDED = frozenset("object svg canvas audio video".split())
_BOILER_TAGS = frozenset("nav footer aside menu dialog button select head search".split()) | _EMBEDDED
# Marks that page builders and form-driven sites also put around a whole page: such a container counts as
# boilerplate only while it holds less than half of the page's words outside of links.
_WEAK_TAGS = frozenset(["form"])
_WEAK_WORDS = frozenset(
    "banner header login modal overlay paywall popup promo related share sharing sidebar signup social subscribe "
    "subscription tags teaser toolbar widget widgets".split()
)
_BOILER_WORDS = frozenset(
    "ad ads advert advertisement advertising banner breadcrumb breadcrumbs byline captcha comment comments "
    "commentlist consent cookie cookies copyright disclaimer disqus footer gdpr header login masthead menu modal "
    "nav navbar navigation newsletter notice notices notification overlay pagination pager paywall popup promo "
    "promotion related replies reply respond share sharing sidebar signup skip social sponsor sponsored subscribe "
    "subscription tags teaser toolbar topbar widget widgets".split()
)
# Names of containers that hold a page's main text where it has no article or main element.
_MAIN_WORDS = frozenset("article articlebody content main maincontent story".split())
_BOILER_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert menu menubar form".split())
_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^'\">]|\"[^\"]*\"|'[^']*')*|[^>]*)>"
    r"|<(?=[a-zA-Z/])[^>]*\Z",
    re.S,
)
_ATTRIBUTE = re.compile(r"""\b(class|id|role|hidden|style|aria-hidden)\s*(?:=\s*("[^"]*"|'[^']*'|[^\s>]+))?""", re.I)
_CLOSES_ITSELF = frozenset("p li dt dd tr td th option".split())


def _boilerplate(tag: str, attributes: str) -> str:
    """What the tag says of its content: ``strong`` or ``weak`` for boilerplate, or nothing."""
    if tag in _BOILER_TAGS:
        return "strong"
    found = "weak" if tag in _WEAK_TAGS else ""
    if not attributes.strip():
        return found
    for name, value in _ATTRIBUTE.findall(attributes):
        name, value = name.lower(), value.strip("\"'").lower()
        if name == "hidden" or name == "aria-hidden" and value == "true":
            return "strong"
        if name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value):
            return "strong"
        if name == "role" and value in _BOILER_ROLES:
            if value != "form":
                return "strong"
            found = "weak"
        if name in ("class", "id") and tag not in ("html", "body", "article", "main"):
            words = _BOILER_WORDS.intersection(w.rstrip("0123456789") for w in re.split(r"[^a-z0-9]+", value))
            if words - _WEAK_WORDS:
                return "strong"
            found = "weak" if words else found
    return found


def _named_main(tag: str, attributes: str) -> bool:
    if tag not in ("div", "section", "td") or not attributes.strip():
        return False
    for name, value in _ATTRIBUTE.findall(attributes):
        words = re.split(r"[^a-z0-9]+", value.strip("\"'").lower())
        if name.lower() in ("class", "id", "role") and _MAIN_WORDS.intersection(words):
            return True
    return False


class _Open:
    """The open elements, with counts of what the text inside them depends on: each step takes the same time
    however deep the page is nested."""

    def __init__(self):
        self.stack: list[tuple] = []
        self.tags: dict[str, int] = {}
        self.strong = self.named = self.headings = 0
        self.headers: list[bool] = []  # open headers: whether they stand in an article
        self.regions: list[int] = []  # open articles: how many weak containers were open before
        self.weak: list[int] = []  # open weak containers
        self.parents: list[int] = []  # of each weak container seen, the one around it or -1

    def push(self, tag: str, attributes: str) -> None:
        mark, named = _boilerplate(tag, attributes), _named_main(tag, attributes)
        self.stack.append((tag, mark, named))
        self.tags[tag] = self.tags.get(tag, 0) + 1
        self.strong += mark == "strong"
        self.named += named
        self.headings += _is_heading(tag)
        if tag == "header":
            self.headers.append(self.tags.get("article", 0) > 0)
        if tag in ("article", "main"):
            self.regions.append(len(self.weak))
        if mark == "weak":
            self.parents.append(self.weak[-1] if self.weak else -1)
            self.weak.append(len(self.parents) - 1)

    def pop(self) -> str:
        tag, mark, named = self.stack.pop()
        self.tags[tag] -= 1
        self.strong -= mark == "strong"
        self.named -= named
        self.headings -= _is_heading(tag)
        if tag == "header":
            self.headers.pop()
        if tag in ("article", "main"):
            self.regions.pop()
        if mark == "weak":
            self.weak.pop()
        return tag

    def top(self) -> str:
        return self.stack[-1][0] if self.stack else ""

    def has(self, tag: str) -> bool:
        return self.tags.get(tag, 0) > 0

    def inner_weak(self) -> int:
        """The innermost weak container, of those within the innermost article if there is one; else -1."""
        within = self.regions[-1] if self.regions else 0
        return self.weak[-1] if len(self.weak) > within else -1


def _is_heading(tag: str) -> bool:
    return len(tag) == 2 and tag[0] == "h" and tag[1].isdigit()


def blocks(page: str) -> list[dict]:
    """The page's text blocks in order: text, words, linked words, main, boiler, heading, item."""
    out: list[dict] = []
    parts: list[str] = []
    linked: list[str] = []
    at_tags = _Open()
    seen_main = False

    def close() -> None:
        if not parts:
            return
        text = " ".join("".join(parts).split())
        if text:
            heading = at_tags.headings > 0
            title = heading and bool(at_tags.headers) and at_tags.headers[-1]
            out.append(
                {
                    "text": text, "words": len(text.split()), "linked": len("".join(linked).split()),
                    "inside": at_tags.has("article") or at_tags.has("main"), "named": at_tags.named > 0,
                    "boiler": at_tags.strong > 0 or bool(at_tags.headers) and not title,
                    "heading": heading, "item": at_tags.has("li"), "weak": at_tags.inner_weak(),
                }
            )
        parts.clear()
        linked.clear()

    def add(raw: str) -> None:
        text = html.unescape(raw) if "&" in raw else raw
        parts.append(text)
        if at_tags.has("a"):
            linked.append(text + " ")

    at = 0
    while at < len(page):
        match = _TOKEN.search(page, at)
        if match is None:
            add(page[at:])
            break
        if match.start() > at:
            add(page[at : match.start()])
        at = match.end()
        if not match.group(2):
            continue
        tag, ending = match.group(2).lower(), match.group(1)
        if tag in _RAW and not ending:
            if not match.group(3).rstrip().endswith("/"):
                end = re.compile(f"</{tag}[^>]*(?:>|\\Z)", re.I).search(page, at)
                at = end.end() if end else len(page)
            continue
        if tag == "br":
            parts.append(" ")
            continue
        if tag in _BLOCK or tag in _EMBEDDED:
            close()
        if tag in _VOID:
            continue
        if ending:
            if at_tags.has(tag):
                while at_tags.pop() != tag:
                    pass
            continue
        if tag in _BLOCK:  # an open paragraph, item or embedded element ends where the next block begins
            while at_tags.top() in _EMBEDDED or at_tags.top() and at_tags.top() not in _BLOCK and at_tags.has("p"):
                at_tags.pop()
            if at_tags.top() == "p" or tag in _CLOSES_ITSELF and at_tags.top() == tag:
                at_tags.pop()
        if tag in _EMBEDDED and match.group(3).rstrip().endswith("/"):
            continue
        seen_main |= tag in ("article", "main")
        at_tags.push(tag, match.group(3))
    close()
    if not seen_main:  # containers named as the main text count where there is no element for it
        for block in out:
            block["inside"] = block["named"]
        seen_main = any(b["inside"] for b in out)
    for block in out:
        block["main"] = 1 if block.pop("inside") else -1 if seen_main else 0
    _weigh(out, at_tags.parents)
    return out


def _weigh(found: list[dict], parents: list[int]) -> None:
    """Blocks of weak containers are boilerplate unless the innermost one holds half of the page's plain words."""
    plain = lambda b: 0 if b["boiler"] else max(0, b["words"] - b["linked"])
    held = [0] * len(parents)
    for b in found:
        if b["weak"] >= 0:
            held[b["weak"]] += plain(b)
    for n in reversed(range(len(parents))):  # a container comes after the one around it
        if parents[n] >= 0:
            held[parents[n]] += held[n]
    total = sum(plain(b) for b in found)
    for b in found:
        weak = b.pop("weak")
        if weak >= 0 and 2 * held[weak] < total:
            b["boiler"] = True


def features(found: list[dict]) -> np.ndarray:
    """A row of ``FEATURES`` per block; neighbours beyond the ends have no words."""
    words = np.array([b["words"] for b in found], float)
    density = np.array([b["linked"] for b in found], float) / np.maximum(words, 1)
    before = lambda x: np.concatenate([[0.0], x[:-1]])
    after = lambda x: np.concatenate([x[1:], [0.0]])
    flags = [np.array([float(b[k]) for b in found]) for k in ("main", "boiler", "heading", "item")]
    return np.column_stack([words, density, before(words), before(density), after(words), after(density), *flags])


class Tree:
    """A binary decision tree grown by Gini impurity until its leaves are pure."""

    def __init__(self, x: np.ndarray, y: np.ndarray, depth: int = 8):
        self.split = None
        self.value = float(y.mean()) >= 0.5
        if depth == 0 or y.min() == y.max():
            return
        best = (1e9, 0, 0.0)
        for k in range(x.shape[1]):
            levels = np.unique(x[:, k])
            for cut in (levels[:-1] + levels[1:]) / 2:
                left = x[:, k] <= cut
                cost = sum(s.sum() * (p := y[s].mean()) * (1 - p) for s in (left, ~left))
                if cost < best[0] - 1e-12:
                    best = (cost, k, cut)
        if best[0] == 1e9:
            return
        self.split = best[1:]
        left = x[:, best[1]] <= best[2]
        self.low, self.high = Tree(x[left], y[left], depth - 1), Tree(x[~left], y[~left], depth - 1)

    def predict(self, x: np.ndarray) -> np.ndarray:
        if self.split is None:
            return np.full(len(x), self.value)
        left = x[:, self.split[0]] <= self.split[1]
        out = np.empty(len(x), bool)
        out[left], out[~left] = self.low.predict(x[left]), self.high.predict(x[~left])
        return out


def expanded(labelled=LABELLED) -> np.ndarray:
    """The labelled table with variants that keep their label.

    Where the page says what a block belongs to (a main region, outside of it, a boilerplate
    container), its size, links and neighbours don't matter; elsewhere sizes may be some third
    smaller or larger. So the tree cannot take a chance pattern of few rows for a rule.
    """
    rows = []
    for words, density, pw, pd, nw, nd, main, boiler, heading, item, label in labelled:
        if main or boiler:
            around = ((0, 0.0), (2, 1.0), (60, 0.0))
            for w in (1, 6, 45, 200):
                for d in (0.0, 1.0):
                    rows += [(w, d, *a, *b, main, boiler, heading, item, label) for a in around for b in around]
        for scale in (0.7, 1.0, 1.4):
            sizes = (max(1, words * scale), density, pw * scale, pd, nw * scale, nd)
            rows.append((*sizes, main, boiler, heading, item, label))
    return np.array(rows, float)


def train(labelled=LABELLED) -> Tree:
    table = expanded(labelled)
    return Tree(table[:, :-1], table[:, -1])


@lru_cache(maxsize=1)
def _tree() -> Tree:
    return train()


def main_text(page: str | None, tree: Tree | None = None) -> str:
    """The article's blocks joined by line feeds; empty if there is none."""
    found = blocks(page or "")
    if not found:
        return ""
    keep = (tree or _tree()).predict(features(found))
    return "\n".join(b["text"] for b, k in zip(found, keep) if k)


def extract(
    pages: DataFrame, id_col: str = "page_id", page: str = "html", keep: tuple[str, ...] = (), labelled=LABELLED
) -> DataFrame:
    """One row per row of ``pages``: id, the columns ``keep``, text (the main text of the whole page).

    Null and empty pages have the text "". Repeated rows repeat; an empty table gives no rows. Other
    columns are not read.
    """
    plain = pages.select(pages[page].alias("_page"), pages[id_col], *[pages[c] for c in keep])
    others = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in plain.schema.fields[1:])

    def run(batches):
        tree = train(labelled)
        for batch in batches:
            for part in slices(batch, 256):
                texts = [main_text(p, tree) for p in part.column(0).to_pylist()]
                columns = [*part.columns[1:], pa.array(texts, pa.string())]
                yield pa.RecordBatch.from_arrays(columns, [*part.schema.names[1:], "text"])

    return plain.mapInArrow(run, f"{others}, text string")
