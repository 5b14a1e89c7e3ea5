"""Text of the container element of a page."""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

# Elements that have no content, and those whose text is not part of a paragraph's text.
VOID = frozenset(
    "area base basefont bgsound br col command embed frame hr image img input isindex keygen link menuitem meta "
    "nextid param source spacer track wbr".split())
UNSEEN = frozenset("script style template".split())


class Selector:
    """Conditions an element must all meet: tag name, id, class and further attributes."""

    def __init__(self, config: dict):
        regex = bool(config.get("regex"))
        wanted = {key: config.get(key) for key in ("name", "id", "class_")}
        tests = {"class" if key == "class_" else key: value for key, value in wanted.items() if value is not None}
        self.name = self._test(tests.pop("name"), regex) if "name" in tests else None
        self.attributes = [(key, self._test(value, regex)) for key, value in tests.items()]
        # Nested attributes are compared as they are.
        self.attributes += [(key, self._test(value, False)) for key, value in (config.get("attrs") or [])]

    @staticmethod
    def _test(value: str, regex: bool):
        if regex:
            pattern = re.compile(value)
            return lambda text: pattern.search(text) is not None
        return lambda text: text == value

    def matches(self, tag: str, attributes: dict[str, str]) -> bool:
        if self.name and not self.name(tag):
            return False
        for key, test in self.attributes:
            if key not in attributes:
                return False
            value = attributes[key]
            # One of the classes may match, or all of them as written.
            options = [*value.split(), value] if key == "class" else [value]
            if not any(test(option) for option in options):
                return False
        return True


class _Container:
    """The first element that matches one selector, and the text of each ``<p>`` below it."""

    def __init__(self, selector: Selector):
        self.selector = selector
        self.depth = 0  # open elements up to and including the container, 0 before it is found
        self.done = False
        self.texts: list[list[str]] = []
        self.active: list[tuple[int, list[str]]] = []

    def closed(self, place: int) -> None:
        """The element at this depth has ended, with all below it."""
        while self.active and self.active[-1][0] >= place:
            self.active.pop()
        if self.depth and place <= self.depth:
            self.done = True


class _Found(Exception):
    """What is still unread cannot change the result."""


class _Paragraphs(HTMLParser):
    """Follows all selectors of a list in one reading, and stops where the container of the first has ended.

    An end tag closes the open elements up to its own and is ignored without one; a ``<p>`` is not closed by the
    next, so text after an unclosed one belongs to both, unless ``close_paragraphs`` is set.
    """

    def __init__(self, selectors: list[Selector], close_paragraphs: bool):
        super().__init__(convert_charrefs=True)
        self.containers, self.close_paragraphs = [_Container(s) for s in selectors], close_paragraphs
        self.open: list[str] = []

    def _settle(self) -> None:
        if self.containers[0].done:
            raise _Found

    def handle_starttag(self, tag, attrs):
        attributes = {key: value or "" for key, value in attrs}
        if tag == "p" and self.close_paragraphs:
            inner = [c.active[-1][0] for c in self.containers if c.active and not c.done]
            if inner:
                self._close(max(inner))
        starts = [c for c in self.containers if not c.depth and c.selector.matches(tag, attributes)]
        if tag in VOID:
            for container in starts:
                container.depth, container.done = len(self.open) + 1, True
            return self._settle()
        self.open.append(tag)
        for container in starts:
            container.depth = len(self.open)
        if tag == "p":
            for container in self.containers:
                if container.depth and not container.done and container not in starts:
                    text: list[str] = []
                    container.texts.append(text)
                    container.active.append((len(self.open), text))

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        self.handle_endtag(tag)

    def handle_endtag(self, tag):
        for place in range(len(self.open), 0, -1):
            if self.open[place - 1] == tag:
                self._close(place)
                return

    def _close(self, place: int) -> None:
        del self.open[place - 1:]
        for container in self.containers:
            container.closed(place)
        self._settle()

    def handle_data(self, data):
        for container in self.containers:
            if container.active and not container.done and not UNSEEN.intersection(self.open[container.active[-1][0]:]):
                for _, text in container.active:
                    text.append(data)


def container_text(html: str, selectors: list[dict], close_paragraphs: bool = False) -> str | None:
    """Paragraph texts of the container that the first selector with one finds, joined by a blank; None when no selector finds one."""
    if not selectors:
        return None
    parser = _Paragraphs([Selector(config) for config in selectors], close_paragraphs)
    try:
        parser.feed(html)
        parser.close()
    except _Found:
        pass
    found = next((c for c in parser.containers if c.depth), None)
    return None if found is None else " ".join("".join(text) for text in found.texts)


def extract_container_text(pages: DataFrame, close_paragraphs: bool = False, keep: tuple[str, ...] = ()) -> DataFrame:
    """``(article_id, content, parser_config)`` to ``(article_id, content)`` and the columns to ``keep``; null where no container is found."""
    schema = T.StructType([pages.schema["article_id"], T.StructField("content", T.StringType()), *[pages.schema[c] for c in keep]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [container_text(html, config, close_paragraphs) if html is not None and config else None
                     for html, config in zip(batch["content"].to_pylist(), batch["parser_config"].to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [batch["article_id"], pa.array(texts, pa.string()), *[batch[c] for c in keep]], names=["article_id", "content", *keep])

    return pages.select("article_id", "content", "parser_config", *keep).mapInArrow(run, schema)
