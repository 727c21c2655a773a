"""Main text of web pages by tag-path ratios.

A page's text is cut into blocks at block-level tags.  Blocks with the same path of tags from the
root are one group: its text per block and its punctuation per block are averaged, smoothed over the
page's order, and multiplied.  Paths whose fused ratio passes the page's threshold are content.
What the page itself names (article, main; nav, footer, advert or comment classes and the like) enters as
a prior: the ratio of a path below a boilerplate name is zero, and the paths of a named article share its mean ratio, weighted
by length and times BONUS, if that is more than their own.  So headings go with their article, and the threshold decides on all.
A form that holds most of the page's text is the page and no form.  Around an unnamed body, headings, lists, tables and quotes stand on
paths of their own with short texts: such a path goes with a chosen one if it hangs from the same element, unless it is mostly links.

Paths are numbers in a trie of steps and open elements are found by name, so a page takes time and memory in proportion to
its length, however deep it is.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plyframe.llm.shared import prepare

# Fixed values of the HTML standard: elements by how they are read.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style template noscript iframe textarea title svg select".split())
BLOCK = set(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol p pre search section summary table tbody td tfoot th thead tr ul".split()
)
CLOSES_ITSELF = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
SCOPES = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"table"}, "th": {"table"}, "option": set()}

# Own values: names of what is not the article.
NOT_CONTENT = {"nav", "footer", "aside", "menu", "dialog", "button", "head", "search"}
BOILERPLATE = re.compile(
    r"(?:^|[\s_-])(?:ads?|advert\w*|sponsor\w*|promo\w*|banner|nav\w*|menu|breadcrumbs?|sidebar|footer|header|masthead|cookies?|consent|"
    r"notices?|newsletter|subscribe|signup|login|popup|modal|share|social|related|recommend\w*|comments?|replies|disqus|respond|widget|pagination|pager)(?:$|[\s_-])"
)
ARTICLE_CLASS = re.compile(r"(?:^|[\s_-])(?:article|post|entry|story|content|main)(?:$|[\s_-])")
NAME = re.compile(r"[a-zA-Z][^\s/>]*")
TAG_END = re.compile(r"""[^>"']*+(?:"[^"]*+"[^>"']*+|'[^']*+'[^>"']*+)*+>""")
NAMED = re.compile(r"""(?:^|\s)(class|id|role|hidden|aria-hidden)\s*(?:=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""", re.I)
PUNCTUATION = re.compile(r"[.,;:!?…。，、；：！？]")
BONUS = 3.0  # on the mean ratio of a named article
KEEP = 0.35  # a path is content from this share of the page's spread of ratios on


INNER = set("blockquote caption cite dd details dl dt figcaption figure h1 h2 h3 h4 h5 h6 hgroup li ol p pre summary table tbody td tfoot th thead tr ul".split())
MOST = 0.5  # part of a page's text that makes a form the page, and part of a path's text that makes it links


class Block:
    """A text with its path; ``prior`` is 1 within a named article, -1 within boilerplate, else 0.

    ``named`` is the path of the innermost article, ``form`` the number of the outermost form, 0 outside any,
    and ``holder`` the path of the nearest element around that is more than a heading, paragraph, list, table or quote.
    """

    __slots__ = ("form", "holder", "linked", "named", "path", "prior", "text")

    def __init__(self, path: int, prior: int, text: str, linked: int, named: int = 0, form: int = 0, holder: int = 0) -> None:
        self.path, self.prior, self.text, self.linked, self.named, self.form, self.holder = path, prior, text, linked, named, form, holder


class Open:
    """An open element: its path, prior, innermost article's path, outermost form and holder."""

    __slots__ = ("form", "holder", "inner", "mark", "name", "path")

    def __init__(self, name: str, path: int, mark: int, inner: int, form: int, holder: int) -> None:
        self.name, self.path, self.mark, self.inner, self.form, self.holder = name, path, mark, inner, form, holder


def blocks(page: str) -> list[Block]:
    """The page's text blocks in order."""
    found: list[Block] = []
    root = Open("", 0, 0, 0, 0, 0)
    stack = [root]
    places: dict[str, list[int]] = {}  # of the open elements, by name
    blocks_at: list[int] = []  # places of the open block-level elements
    paths: dict[tuple[int, str], int] = {}  # (path, step) to the longer path
    pieces: list[str] = []
    linked, forms, of = 0, 0, root

    def flush() -> None:
        nonlocal linked
        text = " ".join(html.unescape("".join(pieces)).split())
        if text:
            found.append(Block(of.path, of.mark, text, linked, of.inner, of.form, of.holder))
        pieces.clear()
        linked = 0

    def add(text: str) -> None:
        nonlocal of, linked
        if not pieces:
            of = stack[-1]
        if places.get("a"):
            linked += len(text)
        pieces.append(text)

    def innermost(names: Iterable[str]) -> int:
        return max((places[n][-1] for n in names if places.get(n)), default=0)

    def close(names: set[str], barrier: int) -> None:
        """Close the innermost of ``names`` that stands behind the place ``barrier``, and all within it."""
        at = innermost(names)
        while at > barrier and len(stack) > at:
            gone = stack.pop().name
            places[gone].pop()
            if gone in BLOCK:
                blocks_at.pop()

    at, end = 0, len(page)
    while at < end:
        lt = page.find("<", at)
        if lt < 0:
            add(page[at:])
            break
        if lt > at:
            add(page[at:lt])
        if page.startswith("<!--", lt):
            stop = page.find("-->", lt + 4)
            at = end if stop < 0 else stop + 3
            continue
        closing = page.startswith("/", lt + 1)
        m = NAME.match(page, lt + 1 + closing)
        if not m:
            if page[lt + 1 : lt + 2] in ("!", "?", "/"):
                stop = page.find(">", lt)
                at = end if stop < 0 else stop + 1
            else:
                add("<")
                at = lt + 1
            continue
        name = m.group().lower()
        rest = TAG_END.match(page, m.end())
        stop = rest.end() if rest else page.find(">", m.end()) + 1
        if not stop:
            break  # the page ends within a tag
        attributes = page[m.end() : stop - 1]
        at = stop
        if name in BLOCK:
            flush()
        if closing:
            close({name}, 0 if name in BLOCK else blocks_at[-1] if blocks_at else 0)
            continue
        if name == "br":
            add(" ")
        if name in RAW:
            tail = re.compile(f"</{re.escape(name)}[\\s/>]", re.I).search(page, at)
            if tail is None:
                break
            shut = page.find(">", tail.start())
            at = end if shut < 0 else shut + 1
            continue
        if name in VOID:
            continue
        if name in BLOCK:
            close({"p"}, innermost(("td", "th", "button", "caption", "table")))
        if name in CLOSES_ITSELF:
            close(CLOSES_ITSELF[name], innermost(SCOPES[name]))
        own = {k.lower(): (v or "").strip("\"'").lower() for k, v in NAMED.findall(attributes)} if attributes else {}
        around = stack[-1]
        before = around.mark
        said = f"{own.get('class', '')} {own.get('id', '')}".strip()
        role = own.get("role", "")
        if before < 0 or name in NOT_CONTENT or "hidden" in own or own.get("aria-hidden") == "true":
            mark = -1
        elif name == "header" and before < 1:
            mark = -1
        elif role in ("navigation", "banner", "contentinfo", "complementary", "search", "form", "dialog", "alert"):
            mark = -1
        elif name not in ("html", "body", "article", "main") and said and BOILERPLATE.search(said) and not (before < 1 and ARTICLE_CLASS.search(said) and name != "div"):
            mark = -1
        elif name in ("article", "main") or role in ("main", "article"):
            mark = 1
        else:
            mark = before
        own_article = mark > 0 and (name in ("article", "main") or role in ("main", "article"))
        if not attributes.endswith("/") or name in BLOCK:
            path = paths.setdefault((around.path, f"{name}.{said.split()[0]}" if said else name), len(paths) + 1)
            form = around.form
            if name == "form" and not form:
                forms += 1
                form = forms
            places.setdefault(name, []).append(len(stack))
            if name in BLOCK:
                blocks_at.append(len(stack))
            stack.append(Open(name, path, mark, path if own_article else around.inner, form, path if name in BLOCK and name not in INNER else around.holder))
    flush()
    return found


def _without_forms(found: list[Block]) -> None:
    """Text of a form is boilerplate, unless the form holds most of what is not boilerplate anyway."""
    sizes: dict[int, int] = {}
    for b in found:
        if b.prior >= 0:
            sizes[b.form] = sizes.get(b.form, 0) + len(b.text)
    most = MOST * sum(sizes.values())
    for b in found:
        if b.form and sizes.get(b.form, 0) <= most:
            b.prior = -1


def content(found: list[Block]) -> list[Block]:
    """Blocks on the paths whose fused, smoothed ratio passes the threshold, and those that go with them."""
    if not found:
        return []
    _without_forms(found)
    groups: dict[int, list[float]] = {}
    for b in found:
        g = groups.setdefault(b.path, [0.0, 0.0, 0.0, 0.0])
        g[0] += len(b.text)
        g[1] += len(PUNCTUATION.findall(b.text))
        g[2] += b.linked
        g[3] += 1
    raw = np.array([[g[0] / g[3] * (1 - min(1.0, g[2] / max(1.0, g[0]))), 1 + g[1] / g[3]] for g in (groups[b.path] for b in found)])
    kernel = np.array([0.1, 0.8, 0.1])
    smooth = np.column_stack([np.convolve(np.pad(raw[:, j], 1, mode="edge"), kernel, mode="valid") for j in range(2)])
    fused = smooth.prod(axis=1)
    priors = np.array([b.prior for b in found])
    fused[priors < 0] = 0.0
    articles: dict[int, list[int]] = {}
    for i, b in enumerate(found):
        if b.prior > 0:
            articles.setdefault(b.named, []).append(i)
    for where in articles.values():
        sizes = [len(found[i].text) for i in where]
        fused[where] = np.maximum(fused[where], BONUS * np.average(fused[where], weights=sizes))
    limit = KEEP * fused.std()
    best: dict[int, list[float]] = {}
    for b, x in zip(found, fused, strict=True):
        best.setdefault(b.path, []).append(x)
    chosen = {p for p, xs in best.items() if max(xs) > 0 and np.mean(xs) >= limit}
    holders = {b.holder for b in found if b.path in chosen and b.prior == 0}
    beside = {b.path for b in found if b.holder in holders and b.path != b.holder and groups[b.path][2] <= MOST * groups[b.path][0]}
    return [b for b, x in zip(found, fused, strict=True) if b.prior >= 0 and (x > 0 and b.path in chosen or b.prior == 0 and b.path in beside)]


def main_text(page: str | None) -> str:
    return "\n\n".join(b.text for b in content(blocks(page or "")))


def extract(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) of every row of ``pages``.

    Defined cases: null html counts as empty; a page without content has the empty text; unclosed and
    cut off tags are read as a browser would, the rest of an unclosed script is no text; repeated rows are
    read alike; an empty table gives no rows; other columns are ignored.
    """
    prepare(pages.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(x) for x in batch.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array(list(map(len, texts)), pa.int64())],
                names=["page_id", "url", "text", "n_chars"],
            )

    own = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    return own.mapInArrow(run, "page_id long, url string, text string, n_chars long")
