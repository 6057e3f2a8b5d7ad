"""Links of a page with what encloses them, by walking its tags with a stack: what the expressions
of ``vintara.operators.pagetree`` are compared with."""

from __future__ import annotations

from collections.abc import Callable
from html.parser import HTMLParser

from vintara.config.sites import PROGRAM_KEYS

BLOCKS = ("td", "p", "li", "div")
HEADINGS = ("h2", "h3", "h4", "strong", "b")
#: Elements without content, which nothing closes.
EMPTY = ("area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr")


class _Element:
    __slots__ = ("name", "start", "end", "row", "cells", "links", "is_cell", "found")

    def __init__(self, name: str, start: int) -> None:
        self.name, self.start, self.end, self.found = name, start, -1, None
        self.row, self.cells, self.links, self.is_cell = -1, 0, 0, False


class _Page(HTMLParser):
    """Text pieces, headings, and the links to files with the elements around them."""

    def __init__(self, is_file: Callable[[str], bool]) -> None:
        super().__init__(convert_charrefs=True)
        self.is_file, self.pieces, self.open, self.by_name = is_file, [], [], {}
        self.headings, self.found, self.rows, self.tags, self.data = [], [], 0, 0, []

    def handle_data(self, data: str) -> None:
        if not (self.open and self.open[-1].name in ("script", "style")):
            self.data.append(data)

    def _flush(self) -> None:
        if self.data:
            piece = "".join(self.data).strip()
            self.data = []
            if piece:
                self.pieces.append(piece)

    def handle_starttag(self, name: str, attributes: list) -> None:
        self._flush()
        self.tags += 1
        if name in EMPTY:
            return
        element = _Element(name, len(self.pieces))
        if name == "a":
            href = next((v for k, v in attributes if k == "href"), None)
            if href is not None:
                self._link(href)
        elif name in HEADINGS:
            self.headings.append(element)
        elif name == "tr" and self.by_name.get("table"):
            element.row, self.rows = self.rows, self.rows + 1
        elif name == "td":
            element.is_cell = True
            for row in self.by_name.get("tr", ()):
                row.cells += 1
                if row.cells == 1:
                    row.found = element  # the first cell
        self.open.append(element)
        self.by_name.setdefault(name, []).append(element)

    def handle_endtag(self, name: str) -> None:
        self._flush()
        if self.by_name.get(name):
            while self._close().name != name:
                pass

    def _close(self) -> _Element:
        element = self.open.pop()
        self.by_name[element.name].pop()
        element.end = len(self.pieces)
        return element

    def close(self) -> None:
        super().close()
        self._flush()
        while self.open:
            self._close()

    def _link(self, href: str) -> None:
        block = row = None
        cells: list[_Element] = []
        for element in reversed(self.open):
            if element.name in BLOCKS and block is None:
                block = element
            if element.is_cell:
                cells.append(element)
            elif element.row >= 0:
                # the innermost row in which the link stands in a later cell than the first
                if any(cell is not element.found for cell in cells):
                    row = element
                    break
            if block is not None and not self.by_name.get("tr"):
                break
        nth = -1
        if row is not None:
            nth, row.links = row.links, row.links + 1
        if self.is_file(href):
            self.found.append((self.tags, href, block, len(self.headings), row, nth))

    def text(self, element: _Element) -> str:
        return "".join(self.pieces[element.start:element.end])


def _program(text: str) -> str | None:
    text = text.lower()
    return next((program for key, program in PROGRAM_KEYS.items() if key in text), None)


def page_links(html: str, is_file: Callable[[str], bool]) -> list[dict]:
    """Links to files of one page, in order."""
    page = _Page(is_file)
    page.feed(html)
    page.close()
    said: list[str | None] = [None]  # by the last of the first n headings that announces a program
    for heading in page.headings if page.found else ():
        text = page.text(heading)
        said.append((None if "annual" in text.lower() else _program(text)) or said[-1])
    programs: dict[int, str | None] = {}
    cells: dict[int, str] = {}
    out = []
    for pos, href, block, above, row, nth in page.found:
        if block is not None and id(block) not in programs:
            programs[id(block)] = _program(page.text(block))
        if row is not None and id(row) not in cells:
            cells[id(row)] = page.text(row.found)
        out.append({"pos": pos, "href": href, "block": programs[id(block)] if block is not None else None,
                    "heading": said[above], "row": row.row if row is not None else None,
                    "nth": nth if row is not None else None, "cell": cells[id(row)] if row is not None else None})
    return out
