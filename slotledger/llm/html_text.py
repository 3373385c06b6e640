"""Main text of web pages by minimum-cut labelling of their blocks.

A page is cut into blocks of text at block-level tags. A classifier gives each block a
cost for being content and one for being boilerplate: what the tags, classes and ids
around it say, how much of the page they wrap, its length, punctuation and share of link text. Neighbouring blocks, and
neighbours under one parent, pay for being labelled apart, the more so the closer they
are in the DOM. The labelling of least total cost is a minimum cut.

Each page is worked on alone, so the job is one pass without a shuffle.

Edge cases: null, empty and text-free pages have text ''; unclosed tags, comments and
scripts end with the page, an unclosed button or option with what is around it; of labellings
that cost the same one is taken, the same on every run; tags cut off at the end are dropped, character references
that are cut off stay as they are; long pages go through whole; extra columns are kept
out; repeated rows give repeated result rows; an empty table gives an empty result.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from slotledger.llm.mincut import label
from slotledger.llm.support import slices

# A quote opens a string only behind an equals sign; a string that never ends does not hide the tag's end.
_MARKUP = re.compile(
    r"""<!--.*?(?:-->|\Z)|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*+)"""
    r"""(?P<rest>(?:[^>=]++|=\s*+(?:"[^"]*+"|'[^']*+'|(?!["'])[^\s>]*+))*+(?=>)|[^>]*+)>"""
    r"""|<[!?][^>]*(?:>|\Z)|<(?P<open>/?[a-zA-Z][^>]*)\Z""",
    re.S,
)
_NAMES = re.compile(r"""(?:^|[\s"'/])(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>"']+))""", re.I)
_PARTS = re.compile(r"[^a-z0-9]+")
_HUMP = re.compile(r"(?<=[a-z])(?=[A-Z])")

# HTML's elements by kind.
_RAW = set("script style title noscript textarea iframe noembed noframes".split())  # text up to their end tag
_MUTED = set("template svg object select option optgroup datalist button".split())  # elements that show no prose
_VOID = set("area base br col embed hr img input link meta param source track wbr".split())
_INLINE = set(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span "
    "strike strong sub sup time tt u var math mi mn mo mrow msup msub mfrac mtext semantics annotation".split()
) | (_VOID - {"hr"})
_CLOSES_P = set("p div ul ol dl table section article aside header footer nav main form h1 h2 h3 h4 h5 h6 pre blockquote".split())

# What tags and names around a block say about it.
_MAIN_TAGS = {"article", "main"}
_EDGE_TAGS = set("nav footer header aside form menu dialog".split())
_MAIN_NAMES = set("article main content post entry story".split())
_EDGE_NAMES = set(
    "ad ads advert advertisement adverts banner breadcrumb breadcrumbs consent cookie cookies copyright disclaimer "
    "footer header login masthead menu modal nav navbar navigation newsletter notice notices notification pagination "
    "pager popup promo promoted recommended related search share sharing sidebar signup social sponsor sponsored "
    "subscribe teaser toolbar tracking widget".split()
)
_REPLY_NAMES = set("comment comments reply replies respond disqus".split())
_ABOUT_OTHERS = set("has with without no is show hide".split())  # "has-sidebar" names what stands elsewhere
_STATES = set("open closed enabled disabled".split())  # "comments-open" too

# Costs, in nats: how sure each sign is.
_EDGE, _REPLY, _MAIN, _OUTSIDE = -6.0, -8.0, 5.0, -2.5
_NEAR, _SIBLING = 0.8, 0.6  # of being labelled unlike a neighbour in the page, or under one parent
_WRAPPER = 0.5  # share of a page's words from which on names do not make an element boilerplate


def _verdicts(rest: str) -> tuple[int, bool]:
    """What the names of an element say: above 0 main part, below 0 around it; and whether it is for readers' replies.

    A name speaks by the last of its words that says anything: "entry-footer" is a footer.
    """
    said, reply = 0, False
    for found in _NAMES.findall(rest):
        for name in "".join(found).split():
            parts = [p for p in _PARTS.split(_HUMP.sub("-", name).lower()) if p]
            if not parts or parts[0] in _ABOUT_OTHERS or parts[-1] in _STATES:
                continue
            reply = reply or any(p in _REPLY_NAMES for p in parts)
            for part in reversed(parts):
                if part in _MAIN_NAMES or part in _EDGE_NAMES:
                    said += 1 if part in _MAIN_NAMES else -1
                    break
    return said, reply


class _Element:
    __slots__ = ("tag", "depth", "link", "muted", "parent", "said", "reply", "words", "_sign")

    def __init__(self, tag: str, parent: _Element | None, rest: str):
        self.tag, self.parent = tag, parent
        self.depth = parent.depth + 1 if parent else 0
        self.link = tag == "a" or (parent is not None and parent.link)
        self.muted = tag in _MUTED or (parent is not None and parent.muted)
        self.said, self.reply = _verdicts(rest) if "=" in rest and tag not in ("html", "body") else (0, False)
        self.words = 0  # of the blocks inside
        self._sign: int | None = None

    def sign(self, page_words: int) -> int:
        """1 main part, -1 around it, -2 readers' comments, 0 unknown."""
        path = []
        here: _Element | None = self
        while here is not None and here._sign is None:
            path.append(here)
            here = here.parent
        above = here._sign if here is not None else 0
        for element in reversed(path):
            above = element._sign = element._judge(above, page_words)
        return above

    def _judge(self, above: int, page_words: int) -> int:
        # What wraps most of a page is not boilerplate for one of its names.
        wrapper = self.words >= _WRAPPER * page_words
        if above == -2 or self.reply:
            return -2
        named = 0 if wrapper and self.said < 0 else self.said
        if self.tag in _MAIN_TAGS:
            return above if above == -1 else (-1 if named < 0 else 1)
        if named < 0 or (self.tag in _EDGE_TAGS and not (self.tag == "header" and above == 1)):
            return -1
        return 1 if named > 0 and above == 0 else above


class Block:
    __slots__ = ("text", "element", "linked")

    def __init__(self, text: str, element: _Element, linked: int):
        self.text, self.element, self.linked = text, element, linked


def blocks(page: str) -> list[Block]:
    """Blocks of text in page order, white space made single and trimmed."""
    out: list[Block] = []
    root = _Element("", None, "")
    here, parts, linked, at = root, [], 0, 0

    def close() -> None:
        nonlocal linked
        text = " ".join("".join(parts).split())
        if text:
            home = here
            while home.tag in _INLINE or home.muted:
                home = home.parent
            out.append(Block(text, home, linked))
        parts.clear()
        linked = 0

    def take(raw: str) -> None:
        nonlocal linked
        if raw and not here.muted:
            text = html.unescape(raw) if "&" in raw else raw
            parts.append(text)
            if here.link:
                linked += len(text)

    size, skip_to = len(page), -1
    for found in _MARKUP.finditer(page):
        if found.start() < skip_to:
            continue
        take(page[max(at, skip_to) : found.start()])
        at = found.end()
        tag = found["tag"]
        if tag is None:
            continue
        tag = tag.lower()
        if tag in _RAW and not found["end"]:
            if not found["rest"].endswith("/"):
                end = re.compile(rf"</{re.escape(tag)}\b[^>]*(?:>|\Z)", re.I).search(page, at)
                at = skip_to = end.end() if end else size
            parts.append(" ")
            continue
        if tag in _MUTED:
            parts.append(" ")
            if here.tag == tag and tag in ("option", "button") and not found["end"]:
                here = here.parent  # the next one ends it
        elif tag == "br":
            parts.append(" ")
        elif tag not in _INLINE and not here.muted:
            close()
        if found["end"]:
            level = here
            while level is not root and level.tag != tag:
                level = level.parent
            if level is not root:
                here = level.parent
        elif tag not in _VOID and not found["rest"].endswith("/"):
            if tag in _CLOSES_P:
                level = here
                while level.tag in _INLINE:
                    level = level.parent
                if level.tag == "p":
                    here = level.parent
            here = _Element(tag, here, found["rest"])
    take(page[max(at, skip_to) :])
    close()
    return out


def _preference(block: Block, sign: int, has_main: bool) -> float:
    """Above 0: cost of calling it boilerplate; below 0: cost of calling it content."""
    text = block.text
    if sign == -2:
        return _REPLY
    words = text.count(" ") + 1
    links = min(1.0, block.linked / max(1, len(text)))
    score = -1.2 + 0.08 * min(words, 40) - 4.0 * links
    score += 0.8 if text[-1] in ".!?…\"”»" else 0.0
    if block.element.tag[:1] == "h" and block.element.tag[1:].isdigit():
        score += 1.5
    if sign == 1:
        return max(score, -1.5) + _MAIN
    if sign == -1:
        return min(score, 1.5) + _EDGE
    return score + (_OUTSIDE if has_main else 0.0)


def _nearness(a: _Element, b: _Element) -> float:
    """Share of the two paths that is common, 1 for one parent."""
    total = a.depth + b.depth + 2
    while a is not b:
        if a.depth >= b.depth:
            a = a.parent
        else:
            b = b.parent
    return 2 * (a.depth + 1) / total


def main_text(page: str) -> str:
    """The blocks labelled content, one a line."""
    found = blocks(page)
    page_words = 0
    for block in found:
        words = block.text.count(" ") + 1
        page_words += words
        element: _Element | None = block.element
        while element is not None:
            element.words += words
            element = element.parent
    signs = [b.element.sign(page_words) for b in found]
    has_main = 1 in signs
    ties, latest = [], {}
    for i, block in enumerate(found):
        if i:
            ties.append((i - 1, i, _NEAR * _nearness(found[i - 1].element, block.element)))
        parent = block.element.parent or block.element
        if (before := latest.get(id(parent))) is not None:
            ties.append((before, i, _SIBLING))
        latest[id(parent)] = i
    kept = label([_preference(b, sign, has_main) for b, sign in zip(found, signs)], ties)
    return "\n".join(b.text for b, keep in zip(found, kept) if keep)


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in (part for whole in batches for part in slices(whole)):
        texts = [main_text(page) for page in batch.column("_html").to_pylist()]
        kept = [n for n in batch.schema.names if n != "_html"]
        yield pa.RecordBatch.from_arrays(
            [*[batch.column(n) for n in kept], pa.array(texts, pa.string())], names=[*kept, "text"]
        )


def extract_text(
    pages: DataFrame,
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
    **others: Column,
) -> DataFrame:
    """Per row: ``id_col``, ``url_col``, ``text``, ``n_chars`` (code points) and ``others``."""
    plain = pages.select(
        F.col(id_col).alias("_id"),
        F.col(url_col).alias("_url"),
        F.coalesce(F.col(html_col), F.lit("")).alias("_html"),
        *[column.alias(f"_o_{name}") for name, column in others.items()],
    )
    kept = [f for f in plain.schema.fields if f.name != "_html"]
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in kept)
    return plain.mapInArrow(_extract, f"{schema}, text string").select(
        F.col("_id").alias(id_col),
        F.col("_url").alias(url_col),
        "text",
        F.length("text").cast("bigint").alias("n_chars"),
        *[F.col(f"_o_{name}").alias(name) for name in others],
    )
