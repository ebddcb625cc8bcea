"""Main text of web pages by tag-path ratios.

A page is read once into text nodes, each with its path of tags from the root. Scripts, styles,
form controls, menus, headers, footers and hidden elements are left out by their tag or role.
Names of classes and ids that tell of adverts, notices, comments and so on, and forms, are only
suspected: the text of all elements with one path and name is summed, and a suspicion stands
unless they hold more than ``MOST`` of the page's sentences. So an article inside a form, or in
an element whose name happens to tell of something else, is kept. Comments may be longer than
their article; they go wherever there are sentences outside them.

For the rest, the length and the punctuation of all text nodes with one path are summed, linked
text at ``LINKED`` of its own; a path's ratios are these sums over its nodes. The ratios are
smoothed along the nodes in page order, fused by their geometric mean, averaged again over each
path, and paths at ``LAMBDA`` of the page's level or above are content. All nodes of a content
path are taken, short ones too, so a sentence of two words stays among long paragraphs. The
headings of an ``article`` or ``main`` element belong to it whatever their length.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hazeline.llm.inputs import in_slices

LAMBDA, KERNEL = 0.12, (0.25, 0.5, 0.25)
ARTICLE_BONUS, LINKED, MOST, SENTENCE = 3.0, 0.1, 0.5, 20

# Elements of HTML by what they mean for text.
RAW = "script|style|textarea|title|noscript|template|xmp|iframe|noembed|noframes"
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
NO_ARTICLE = set(
    "script style textarea title noscript template iframe xmp noembed noframes head nav footer aside button "
    "select option dialog menu svg math canvas object audio video fieldset label datalist map".split()
)
BLOCKS = set(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol option p pre section select "
    "summary table tbody td tfoot th thead title tr ul".split()
)
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
MAIN = {"article", "main"}
CLOSED_BY = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
    "th": {"td", "th"}, "option": {"option"}, "tbody": {"thead", "tbody", "tr", "td", "th"},
}
BARRIERS = {"table", "ul", "ol", "dl", "select", "div", "section", "article", "body", "html"}
NOISE = re.compile(
    r"(?:^|[\s_-])(?:ads?|adverts?|advertisement|advertising|sponsor(?:ed)?|promo(?:tion)?|banner|cookies?|consent|gdpr|notice|"
    r"popup|modal|overlay|alert|sidebar|side|aside|menu|nav|navbar|navigation|"
    r"breadcrumbs?|footer|header|masthead|topbar|toolbar|share|sharing|social|related|recommend(?:ed|ations)?|newsletter|"
    r"subscribe|subscription|signup|login|search|pagination|pager|tags?|widget|skip|copyright|legal|disclaimer)(?:$|[\s_-])",
    re.I,
)
COMMENTS = re.compile(r"(?:^|[\s_-])(?:comments?|disqus|respond|replies|reply)(?:$|[\s_-])", re.I)
NOISE_ROLES = {
    "navigation", "banner", "contentinfo", "complementary", "search", "dialog", "alert", "alertdialog", "menu",
    "menubar", "toolbar",
}

TOKEN = re.compile(
    rf"<!--.*?(?:-->|\Z)|<({RAW})(?=[\s/>])(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+>.*?(?:</\1\s*>|\Z)"
    r"|<(/?)([a-z][^\s/>]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>|<[!?/][^>]*(?:>|\Z)",
    re.I | re.S,
)
ATTRIBUTE = re.compile(r"(?:^|\s)(class|id|role|hidden|style|aria-hidden)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?(?=\s|/|$)", re.I)
PUNCTUATION = re.compile(r"[.,;:!?…。，、！？；：¿¡]")
HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)


@dataclass
class Element:
    tag: str
    step: str
    left_out: bool
    in_main: bool
    in_link: bool
    #: What this element and those around it are suspected of: (path, name, whether of comments).
    suspected: tuple[tuple[str, str, bool], ...] = ()


@dataclass
class TextNode:
    path: str
    text: str
    block: int
    in_main: bool
    heading: bool
    linked: bool
    suspected: tuple[tuple[str, str, bool], ...] = ()


def _is_noise(tag: str, attributes: dict[str, str], in_main: bool) -> bool:
    if tag in NO_ARTICLE or (tag == "header" and not in_main):
        return True
    if "hidden" in attributes or attributes.get("aria-hidden", "").lower() == "true":
        return True
    if attributes.get("role", "").lower() in NOISE_ROLES or HIDDEN.search(attributes.get("style", "")):
        return True
    return False


def _suspicion(tag: str, attributes: dict[str, str]) -> tuple[str, bool] | None:
    """(name, whether of comments) of an element that may be no part of an article."""
    if tag in ("html", "body", "main", "header") or tag in HEADINGS:
        return None
    name = " ".join(attributes.get(a, "") for a in ("class", "id"))
    of_comments = COMMENTS.search(name) is not None
    if tag == "article":
        return (name, True) if COMMENTS.search(attributes.get("class", "")) else None
    noise = of_comments or NOISE.search(name) or tag == "form" or attributes.get("role", "").lower() == "form"
    return (name, of_comments) if noise else None


class _Page:
    """Text nodes of a page, from a stack of open elements; missing end tags are allowed."""

    def __init__(self):
        self.stack: list[Element] = []
        self.nodes: list[TextNode] = []
        self.block = 0

    def open(self, tag: str, attributes: dict[str, str]) -> None:
        if tag in BLOCKS:
            self.block += 1
            self._close_until({"p"}, HEADINGS | {"button"} | BARRIERS - {"body"})
        if tag in CLOSED_BY:
            self._close_until(CLOSED_BY[tag], BARRIERS)
        top = self.stack[-1] if self.stack else Element("", "", False, False, False)
        in_main = top.in_main or tag in MAIN
        left_out = top.left_out or _is_noise(tag, attributes, top.in_main)
        first = attributes.get("class", "").split()[:1]
        step = f"{tag}.{first[0]}" if first and tag in BLOCKS else tag
        path, suspected = f"{top.step}/{step}", top.suspected
        if not left_out and (found := _suspicion(tag, attributes)):
            suspected += ((path, *found),)
        self.stack.append(Element(tag, path, left_out, in_main, top.in_link or tag == "a", suspected))

    def _close_until(self, tags: set[str], barriers: set[str]) -> None:
        for at in range(len(self.stack) - 1, -1, -1):
            tag = self.stack[at].tag
            if tag in tags:
                del self.stack[at:]
                if tags & {"tr", "tbody"}:
                    continue
                return
            if tag in barriers:
                return

    def close(self, tag: str) -> None:
        if tag in BLOCKS:
            self.block += 1
        for at in range(len(self.stack) - 1, -1, -1):
            if self.stack[at].tag == tag:
                del self.stack[at:]
                return

    def text(self, raw: str) -> None:
        top = self.stack[-1] if self.stack else Element("", "", False, False, False)
        if not top.left_out:
            tags = top.step
            heading = any(f"/{h}" in tags for h in HEADINGS)
            self.nodes.append(TextNode(tags, raw, self.block, top.in_main, heading, top.in_link, top.suspected))


def text_nodes(html: str) -> list[TextNode]:
    """Text nodes that may be part of an article, in page order."""
    page, at = _Page(), 0
    for m in TOKEN.finditer(html):
        if m.start() > at:
            page.text(html[at : m.start()])
        at = m.end()
        tag = (m[3] or "").lower()
        if not tag:
            if m[1]:
                page.block += 1
        elif m[2]:
            page.close(tag)
        elif tag in VOID:
            page.text(" ")
            page.block += tag == "hr"
        else:
            found = {a[1].lower(): a[2] or a[3] or a[4] or "" for a in ATTRIBUTE.finditer(m[4])} if m[4] else {}
            page.open(tag, found)
    if at < len(html):
        page.text(html[at:])
    return page.nodes


def _sentences(node: TextNode) -> int:
    """Length of a node's text if it is as long as a short sentence, unlinked and has punctuation."""
    text = node.text.strip()
    return len(text) if len(text) >= SENTENCE and not node.linked and PUNCTUATION.search(text) else 0


def unsuspected(nodes: list[TextNode]) -> list[TextNode]:
    """Nodes outside elements whose suspicion stands. What is judged by are the sentences outside
    comments, and of these the ones of ``article`` and ``main`` elements, if there are any."""
    if not any(n.suspected for n in nodes):
        return nodes
    judged = nodes
    for chosen in (lambda n: not any(s[2] for s in n.suspected), lambda n: n.in_main):
        fewer = [n for n in judged if chosen(n)]
        judged = fewer if any(map(_sentences, fewer)) else judged
    sums: dict[tuple[str, str, bool], int] = {}
    for node in judged:
        for suspicion in set(node.suspected):
            sums[suspicion] = sums.get(suspicion, 0) + _sentences(node)
    limit = MOST * sum(map(_sentences, judged))
    cleared = {s for s, n in sums.items() if n > limit}
    return [n for n in nodes if cleared.issuperset(n.suspected)]


def smoothed(values: list[float]) -> list[float]:
    """Weighted means over neighbours in page order; at the ends the end itself counts twice."""
    last = len(values) - 1
    before, own, after = KERNEL
    return [before * values[max(0, i - 1)] + own * v + after * values[min(last, i + 1)] for i, v in enumerate(values)]


def content_paths(nodes: list[TextNode]) -> set[str]:
    """Paths whose fused ratio reaches the threshold."""
    sums: dict[str, list[float]] = {}
    real = [n for n in nodes if n.text.strip()]
    for node in real:
        text = node.text.strip()
        held = sums.setdefault(node.path, [0.0, 0.0, 0.0])
        held[0] += len(text) * (LINKED if node.linked else 1.0)
        held[1] += (len(PUNCTUATION.findall(text)) + 1) * (LINKED if node.linked else 1.0)
        held[2] += 1
    length = smoothed([sums[n.path][0] / sums[n.path][2] for n in real])
    points = smoothed([sums[n.path][1] / sums[n.path][2] for n in real])
    fused: dict[str, list[float]] = {}
    for node, a, b in zip(real, length, points):
        fused.setdefault(node.path, []).append((a * b) ** 0.5 * (ARTICLE_BONUS if node.in_main else 1.0))
    level = {p: sum(v) / len(v) for p, v in fused.items()}
    total = sum(s[0] for s in sums.values()) or 1.0
    mean = sum(level[p] * s[0] for p, s in sums.items()) / total
    headings = {n.path for n in real if n.heading and n.in_main}
    return {p for p, v in level.items() if v >= LAMBDA * mean} | headings


def main_text(html: str | None) -> tuple[str, int]:
    """The text of content nodes and the number of content paths.

    White space in a block becomes one space and blocks are joined by one. A page without text
    gives the empty text. Character references are decoded.
    """
    nodes = unsuspected(text_nodes(html or ""))
    chosen = content_paths(nodes)
    has_main = any(n.in_main and n.path in chosen for n in nodes)
    blocks: list[list[str]] = []
    last = None
    for node in nodes:
        if node.path not in chosen and (node.text.strip() or last is None):
            continue
        if has_main and not node.in_main:
            continue
        if node.block != last:
            blocks.append([])
            last = node.block
        blocks[-1].append(node.text)
    texts = (" ".join(unescape("".join(b)).split()) for b in blocks)
    return " ".join(t for t in texts if t), len(chosen)


def extracted(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars, n_paths) of every row; a null page is an empty one and rows
    that repeat come out each."""

    def per_batch(batches):
        for batch in in_slices(batches):
            found = [main_text(h) for h in batch["html"].to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    batch["page_id"], batch["url"],
                    pa.array([t for t, _ in found], pa.string()), pa.array([len(t) for t, _ in found], pa.int64()),
                    pa.array([n for _, n in found], pa.int64()),
                ],
                ["page_id", "url", "text", "n_chars", "n_paths"],
            )

    source = pages.select(F.col("page_id").cast("bigint").alias("page_id"), F.col("url").cast("string").alias("url"), "html")
    return source.mapInArrow(per_batch, "page_id bigint, url string, text string, n_chars bigint, n_paths bigint")


def query(spark, folder: str) -> DataFrame:
    from hazeline.llm.inputs import table

    return extracted(table(spark, folder, "pages"))
