"""Thread titles from forum pages, by the pages' tag tree.

Which links count is stated like a selector list; a link in a container needs the tree, as containers
nest. Each page is read once, front to back, with the open elements on a stack; nothing is shuffled.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Sequence
from dataclasses import dataclass, field
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Elements without an end tag; those whose text is not shown.
VOID_TAGS = frozenset("area base br col embed hr img input link meta param source track wbr".split())
HIDDEN_TAGS = frozenset("script style template".split())


@dataclass(frozen=True)
class AnchorRule:
    """Which links of a page are thread links, in the manner of a selector list."""

    classes: tuple[str, ...] = ()
    id_prefixes: tuple[str, ...] = ()
    href_parts: tuple[str, ...] = ()
    container_classes: tuple[str, ...] = ()
    heading_class: str | None = None
    fallback_href_parts: tuple[str, ...] = field(default=())
    limit: int = 15

    def contains(self, tag: str, classes: Sequence[str]) -> bool:
        """Whether links below this element count."""
        heading = tag == "h3" and self.heading_class in classes
        return heading or any(name in classes for name in self.container_classes)

    def accepts(self, attributes: dict[str, str], classes: Sequence[str]) -> bool:
        """Whether a link counts by itself."""
        return (
            any(name in classes for name in self.classes)
            or any(attributes.get("id", "").startswith(prefix) for prefix in self.id_prefixes)
            or any(part in attributes.get("href", "") for part in self.href_parts)
        )


# The two kinds of forum page.
CLASSIC_FORUM = AnchorRule(
    classes=("title",), id_prefixes=("thread_title_",), fallback_href_parts=("showthread",), limit=15
)
MODERN_FORUM = AnchorRule(
    classes=("PreviewTooltip", "title"),
    heading_class="title",
    container_classes=("structItem-title",),
    href_parts=("threads/", "showthread"),
    limit=40,
)


class _Links(HTMLParser):
    """Texts of a page's links, in page order: of those that the rule accepts and of those it falls back to."""

    def __init__(self, rule: AnchorRule):
        super().__init__(convert_charrefs=True)
        self.rule = rule
        # Open elements: tag, whether links below count, whether the text is hidden.
        self.open: list[tuple[str, bool, bool]] = [("", False, False)]
        self.tags: Counter[str] = Counter()
        # Open links: place in the stack, texts.
        self.links: list[tuple[int, list[str]]] = []
        self.text: list[str] = []
        self.accepted: list[list[str]] = []
        self.others: list[list[str]] = []

    def flush(self) -> None:
        """The text since the last tag or comment is one node, stripped, of every open link."""
        text = "".join(self.text).strip() if self.links and not self.open[-1][2] else ""
        self.text.clear()
        if text:
            for _, link in self.links:
                link.append(text)

    def handle_starttag(self, tag, attrs):
        self.flush()
        attributes = {name: value or "" for name, value in attrs}
        classes, (_, inside, hidden) = attributes.get("class", "").split(), self.open[-1]
        if tag == "a":
            link: list[str] = []
            self.links.append((len(self.open), link))
            if inside or self.rule.accepts(attributes, classes):
                self.accepted.append(link)
            elif "href" in attributes and any(part in attributes["href"] for part in self.rule.fallback_href_parts):
                self.others.append(link)
        if tag not in VOID_TAGS:
            self.open.append((tag, inside or self.rule.contains(tag, classes), hidden or tag in HIDDEN_TAGS))
            self.tags[tag] += 1

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID_TAGS:
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        """Closes the last open element of this name and all within it; without one it closes nothing."""
        self.flush()
        if not self.tags[tag]:
            return
        closed = None
        while closed != tag:
            closed = self.open.pop()[0]
            self.tags[closed] -= 1
        while self.links and self.links[-1][0] >= len(self.open):
            self.links.pop()

    def handle_data(self, data):
        self.text.append(data)

    def handle_comment(self, data):
        self.flush()

    handle_decl = handle_pi = unknown_decl = handle_comment


def link_texts(page: str, rule: AnchorRule) -> list[str]:
    """Texts of the first ``rule.limit`` thread links of a page."""
    links = _Links(rule)
    links.feed(page)
    links.close()
    links.flush()
    return ["".join(parts) for parts in (links.accepted or links.others)[: rule.limit]]


def thread_links(page: Column, rule: AnchorRule) -> Column:
    """Array of the texts of a page's thread links; a null page has none."""

    @F.pandas_udf("array<string>")
    def texts(pages: pd.Series) -> pd.Series:
        return pages.map(lambda page: link_texts(page, rule) if page else [])

    return texts(page)


def with_titles(pages: DataFrame, rule: AnchorRule, html_col: str, min_length: int) -> DataFrame:
    """A row per thread title of ``min_length`` or more, as ``text``; the cut of the links comes first."""
    rows = pages.withColumn("_titles", thread_links(F.col(html_col), rule)).drop(html_col)
    return rows.withColumn("text", F.explode("_titles")).drop("_titles").where(F.length("text") >= min_length)
