"""Main text of web pages by tag-path ratios.

Method. A page is a sequence of text blocks, each at the end of a path of block elements from
the root. Per path, text length, punctuation and link text are summed over its blocks; length
and punctuation per block are the path's ratios. The ratios are smoothed over neighbouring
blocks, fused into one value (length times punctuation, less links, more inside an article), and
paths above a share of the page's best value are content, as are an article's headings. Inside an
article links lower a value only so far. Elements that by name, role or class
are menus, headers, footers, sidebars, notices, adverts, forms or reader comments end a path
with value 0, and scripts, styles and the like give no blocks. A class drops no wrapper that holds
the page's main or article element or, without one, most of its unlinked text. Inside an article
only a class of marks and words for boxes alone drops an element; one with other words besides
(``share-price``) does so if most of the element's text is links.

Every page is one row's work: no shuffle.

Defined results
  null or empty html   empty text, no characters
  broken markup        unclosed elements end with their parent; unknown end tags are ignored
  null id or url       passed through; repeated rows: one result each; empty table: no rows
  ties                 paths of equal value are kept or dropped together
  other columns        passed through; ``text`` and ``n_chars`` replace columns of that name
"""

from __future__ import annotations

import html as entities
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import packed

#: Element names of HTML, and words by which pages mark what is not content.
RAW = frozenset("script style noscript template svg iframe object canvas audio video map title".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd mark q ruby rt rp s samp small span strike strong sub sup time tt u var label center".split()
)
NOT_CONTENT = frozenset("nav footer aside form button select textarea fieldset menu dialog head".split())
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert menu menubar".split())
MARKS = frozenset(
    """ad ads advert advertisement adverts advertising sponsor sponsored promo promotion banner nav navbar navigation menu breadcrumb
    breadcrumbs sidebar aside widget related recommended header masthead footer cookie cookies consent notice alert popup modal overlay
    newsletter subscribe signup login share sharing social comment comments commentlist disqus reply replies respond form search pagination
    pager toolbar""".split()
)
#: Words that only say what kind of box, list or place an element is.
BOX = frozenset(
    """box wrapper container block section area slot unit bar list links link items item button buttons icons posts articles stories
    content inner outer wrap panel widget region top bottom left right main side inline primary secondary body text thread user
    reader author feed card row col column grid post entry article page story news site""".split()
)
#: After these a class names what is there or missing beside an element, not the element itself.
BESIDE = frozenset("has with no without".split())
#: Words that may follow "social" in the class of a bar of links.
SOCIAL = MARKS | frozenset("media links link icons icon buttons button bar list follow network networks profiles wrapper container".split())
#: Wrappers so marked are never content for the amount of their text; an article so marked is a comment.
NEVER_LIFTED = frozenset("cookie cookies consent comment comments commentlist disqus reply replies respond".split())
COMMENT = frozenset("comment reply respond".split())
ARTICLE = frozenset(["article", "main"])
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: A start tag of the first kind ends an open element of the second.
ENDS = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
PUNCTUATION = re.compile(r"[.,;:!?。，、；：！？…]")

_TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:"[^"]*"|'[^']*'|[^'">])*+)>""", re.S)
_ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|[0-9]+")

SMOOTHING = np.array([0.25, 0.5, 0.25])
#: Links lower a value inside an article to this share at most: there they are seldom a menu.
LINKED_IN_ARTICLE = 0.5
IN_ARTICLE, SHARE_WITH_ARTICLE, SHARE_WITHOUT = 8.0, 0.05, 0.25


def marks_of(names: str) -> set[str]:
    """The marks among the parts of classes and ids."""
    found = set()
    for name in names.split():
        parts = [p.lower() for p in _PART.findall(name)]
        for part, after in zip(parts, [*parts[1:], "social"]):
            if part in BESIDE:
                break
            if part in MARKS and (part != "social" or after in SOCIAL):
                found.add(part)
    return found


def only_marks(names: str) -> bool:
    """Whether a class or id consists of marks, words for boxes and numbers alone."""
    parts = ([p.lower() for p in _PART.findall(name)] for name in names.split())
    return any(marks_of(" ".join(p)) and all(x in MARKS or x in BOX or x.isdigit() for x in p) for p in parts if p)


class _Paths:
    """Paths as numbers: a child is found by its parent and step."""

    def __init__(self) -> None:
        self.known: dict[tuple[int, str], int] = {}
        self.dropped = [False]
        self.article = [False]
        self.heading = [False]
        self.parent = [0]
        self.element = [""]  # article or main, but for an article that is a comment
        self.marked: dict[int, set[str]] = {}
        self.doubtful: set[int] = set()  # marked paths in an article that count only if their text is links

    def child(self, parent: int, tag: str, attributes: dict[str, str]) -> int:
        marks = f"{attributes.get('class', '')} {attributes.get('id', '')}" if attributes else ""
        role = attributes.get("role", "") if attributes else ""
        hidden = bool(attributes) and ("hidden" in attributes or "display:none" in attributes.get("style", "").replace(" ", ""))
        key = (parent, f"{tag} {marks} {role}{' hidden' if hidden else ''}")
        if key not in self.known:
            path = self.known[key] = len(self.dropped)
            drop = self.dropped[parent] or hidden or tag in NOT_CONTENT or role.lower() in ROLES
            drop = drop or (tag == "header" and not self.article[parent])
            found = marks_of(marks) if marks.strip() else set()
            if found and tag not in ("html", "body", "article", "main") and tag not in HEADINGS:
                self.marked[path] = found
                if self.article[parent] and not only_marks(marks):
                    self.doubtful.add(path)
            self.dropped.append(drop)
            self.article.append(self.article[parent] or tag in ARTICLE)
            self.heading.append(self.heading[parent] or tag in HEADINGS)
            self.parent.append(parent)
            self.element.append(tag if tag in ARTICLE and found.isdisjoint(COMMENT) else "")
        return self.known[key]

    def drop_marked(self, blocks: list[tuple[int, str, int]]) -> None:
        """Drop paths with a marked element, but for wrappers of the page's main or article element or of most of its text.

        An article counts only if none is outside marked elements, the amount of text only if there is
        no article: others are teasers and notices.
        """
        if not self.marked:
            return
        n = len(self.parent)
        unlinked, links, shown = [0] * n, [0] * n, [False] * n
        holds: dict[str, list[bool]] = {tag: [False] * n for tag in ARTICLE}
        open_paths = {path for path, _, _ in blocks if not self.dropped[path]}
        for path, text, linked in blocks:
            if path in open_paths:
                unlinked[path] += len(text) - linked
                links[path] += linked
                shown[path] = True
        for path in range(n - 1, 0, -1):  # a child's number is larger than its parent's
            up = self.parent[path]
            unlinked[up] += unlinked[path]
            links[up] += links[path]
            shown[up] = shown[up] or shown[path]
            for tag, inside in holds.items():
                inside[up] = inside[up] or inside[path] or (shown[path] and self.element[path] == tag)
        for path in self.doubtful:
            if links[path] <= unlinked[path]:
                del self.marked[path]
        lifted: set[int] = set()

        def closed() -> list[bool]:
            out = [False] * n
            for path in range(1, n):
                out[path] = out[self.parent[path]] or (path in self.marked and path not in lifted)
            return out

        def found() -> bool:
            out = closed()
            return any(self.article[path] and not out[path] for path in open_paths)

        lifted.update(path for path in self.marked if holds["main"][path])
        if not found():
            lifted.update(path for path in self.marked if holds["article"][path])
        if not found():
            lifted.update(path for path, marks in self.marked.items() if marks.isdisjoint(NEVER_LIFTED) and 2 * unlinked[path] > unlinked[0])
        self.dropped = [a or b for a, b in zip(self.dropped, closed())]


def blocks_of(page: str) -> tuple[list[tuple[int, str, int]], _Paths]:
    """(path, text, characters within links) of each block with text, in page order."""
    paths, out = _Paths(), []
    stack: list[tuple[str, int]] = [("", 0)]
    open_tags: dict[str, int] = {}
    parts: list[tuple[str, bool]] = []
    links = 0

    def end_block() -> None:
        if parts:
            text = " ".join(entities.unescape("".join(t for t, _ in parts)).split())
            if text:
                linked = sum(len(entities.unescape(t).strip()) for t, inside in parts if inside)
                out.append((stack[-1][1], text, min(len(text), linked)))
            parts.clear()

    def close(tag: str) -> None:
        while len(stack) > 1:
            name, _ = stack.pop()
            open_tags[name] -= 1
            if name == tag:
                return

    at, raw = 0, None
    while True:
        if raw:  # skip to the end tag of a script or the like
            found = re.compile(rf"</{raw}\b[^>]*>?", re.I).search(page, at)
            if not found:
                break
            at, raw = found.end(), None
        m = _TOKEN.search(page, at)
        if m is None:
            if at < len(page):
                parts.append((page[at:], links > 0))
            break
        if m.start() > at:
            parts.append((page[at : m.start()], links > 0))
        at = m.end()
        if m.group(2) is None:
            continue
        tag, ending = m.group(2).lower(), bool(m.group(1))
        if tag == "br":
            parts.append((" ", False))
        elif tag in INLINE:
            if tag == "a":
                links = max(0, links - 1) if ending else links + 1
        elif tag in VOID:
            if tag == "hr":
                end_block()
        elif tag in RAW:
            if not ending and not m.group(3).rstrip().endswith("/"):
                raw = tag
        elif ending:
            end_block()
            links = 0
            if open_tags.get(tag):
                close(tag)
        else:
            end_block()
            links = 0
            if stack[-1][0] == "p" or (stack[-1][0] in HEADINGS and tag in HEADINGS):  # neither holds blocks
                close(stack[-1][0])
            for other in ENDS.get(tag, ()):
                if stack[-1][0] == other:
                    close(other)
            attributes = {a.lower(): b or c or d or "" for a, b, c, d in _ATTRIBUTE.findall(m.group(3))} if m.group(3) else {}
            stack.append((tag, paths.child(stack[-1][1], tag, attributes)))
            open_tags[tag] = open_tags.get(tag, 0) + 1
    end_block()
    paths.drop_marked(out)
    return out, paths


def main_text(page: str | None) -> str:
    blocks, paths = blocks_of(page or "")
    if not blocks:
        return ""
    path = np.array([b[0] for b in blocks])
    known, place = np.unique(path, return_inverse=True)
    count = np.bincount(place).astype(float)
    length = np.bincount(place, weights=[len(b[1]) for b in blocks]) / count
    signs = np.bincount(place, weights=[len(PUNCTUATION.findall(b[1])) for b in blocks]) / count
    linked = np.bincount(place, weights=[b[2] for b in blocks]) / count / length
    dropped = np.array([paths.dropped[k] for k in known])
    article = np.array([paths.article[k] for k in known])
    heading = article & ~dropped & np.array([paths.heading[k] for k in known])

    def smooth(ratios: np.ndarray) -> np.ndarray:
        """Over neighbouring blocks that may be content, and back to a mean per path."""
        out, open_blocks = np.zeros(len(known)), np.nonzero(~dropped[place])[0]
        series = ratios[place[open_blocks]]
        if len(series):
            padded = np.concatenate([series[:1], series, series[-1:]])
            out += np.bincount(place[open_blocks], weights=np.convolve(padded, SMOOTHING, "valid"), minlength=len(known)) / count
        return out

    value = smooth(np.log1p(length)) * (1 + smooth(np.log1p(signs))) * np.where(article, np.maximum(1 - linked, LINKED_IN_ARTICLE), 1 - linked)
    value = np.where(dropped, 0.0, value * np.where(article, IN_ARTICLE, 1.0))
    best = float(value.max())
    share = SHARE_WITH_ARTICLE if (article & ~dropped).any() else SHARE_WITHOUT
    keep = heading | ((value > 0) & (value >= share * best))
    return "\n".join(b[1] for b, k in zip(blocks, place) if keep[k])


def extract(pages: DataFrame, html_col: str = "html") -> DataFrame:
    """``pages`` with ``text`` and ``n_chars`` (code points)."""
    names = [c for c in pages.columns if c not in ("text", "n_chars")]
    work = packed(pages.select(*[F.col(f"`{c}`") for c in names]), F.col(html_col).alias("html"))
    schema = pa.schema([("text", pa.string()), ("n_chars", pa.int64())])

    def run(batches):
        for batch in batches:
            for a in range(0, batch.num_rows, 500):
                part = batch.slice(a, 500)
                texts = [main_text(h.as_py()) for h in part.column("html")]
                yield pa.RecordBatch.from_arrays([part.column("row"), pa.array(texts, schema[0].type), pa.array([len(t) for t in texts], schema[1].type)], names=["row", "text", "n_chars"])

    out = work.mapInArrow(run, T.StructType([work.schema["row"], T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())]))
    return out.select(*[F.col(f"row.`{c}`").alias(c) for c in names], "text", "n_chars")
