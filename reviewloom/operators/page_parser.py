"""Reads the wanted fields of one product page; called for each row of a batch."""

from __future__ import annotations

from collections import Counter
from html.parser import HTMLParser

FIELDS = ("title", "star", "price", "availability", "description", "specs")

# Elements without an end tag, and those that end a paragraph.
VOID = frozenset(
    "area base br col embed hr img input link meta param source track wbr".split()
)
ENDS_PARAGRAPH = frozenset(
    "address article aside blockquote center details dir div dl fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split()
)
UNSHOWN = frozenset(("script", "style", "template"))
CELLS = ("td", "th")
TABLE_PARTS = frozenset(("table", "thead", "tbody", "tfoot", "tr", "td", "th"))
CELL_BOUNDARY = frozenset(("table", "td", "th"))


class _Settled(Exception):
    """All wanted fields are known; the rest of the page need not be read."""


class _Text:
    """Text of an element that is still open, with the depth it was opened at."""

    def __init__(self, depth: int):
        self.depth = depth
        self.parts: list[str] = []

    def stripped(self) -> str:
        return "".join(self.parts).strip()


class _PageReader(HTMLParser):
    def __init__(self, wanted):
        super().__init__()
        self.wanted = frozenset(wanted)
        self.open_tags: list[str] = []
        self.open_count: Counter[str] = Counter()
        self.open_texts: list[_Text] = []
        self.texts: dict[str, _Text] = {}
        self.star: str | None = None
        self.rows: list[dict] = []
        self.open_rows: list[tuple[int, dict]] = []
        self.settled: set[str] = set()
        # Depths of the description heading, of its siblings, of the spec table.
        self.heading_depth: int | None = None
        self.sibling_depth: int | None = None
        self.table_depth: int | None = None

    def updatepos(self, start, end):
        # Line numbers, which the base class keeps for messages, are not needed.
        return end

    # events

    def handle_starttag(self, tag, attrs):
        self._close_implied(tag)
        depth = len(self.open_tags)
        attributes = dict(reversed(attrs))
        classes = (attributes.get("class") or "").split()

        if tag == "h1":
            self._start_text("title", depth)
        elif tag == "p":
            if self.star is None and "star-rating" in classes:
                self.star = classes[1] if len(classes) > 1 else ""
                self._settle("star")
            if "price_color" in classes:
                self._start_text("price", depth)
            if " ".join(classes) == "instock availability":
                self._start_text("availability", depth)
            if depth == self.sibling_depth:
                self._start_text("description", depth)
        elif tag == "div":
            if self.heading_depth is None and attributes.get("id") == "product_description":
                self.heading_depth = depth
        elif tag == "table":
            if self.table_depth is None and "table-striped" in classes:
                self.table_depth = depth
        elif self._in_spec_table():
            if tag == "tr":
                row = {}
                self.rows.append(row)
                self.open_rows.append((depth, row))
            elif tag in CELLS:
                cell = None
                for _, row in self.open_rows:
                    if tag not in row:
                        cell = cell or self._open_text(depth)
                        row[tag] = cell
        if tag not in VOID:
            self.open_tags.append(tag)
            self.open_count[tag] += 1

    def handle_startendtag(self, tag, attrs):
        # "<p/>" opens a paragraph in HTML; only void elements end at once.
        self.handle_starttag(tag, attrs)

    def handle_endtag(self, tag):
        if not self.open_count[tag]:
            return
        for depth in range(len(self.open_tags) - 1, -1, -1):
            open_tag = self.open_tags[depth]
            if open_tag == tag:
                self._close_down_to(depth)
                return
            if open_tag in CELL_BOUNDARY and tag not in TABLE_PARTS:
                return

    def handle_data(self, data):
        if self.open_texts and not (self.open_tags and self.open_tags[-1] in UNSHOWN):
            for text in self.open_texts:
                text.parts.append(data)

    # open elements

    def _close_implied(self, tag):
        if tag in ENDS_PARAGRAPH and self.open_count["p"]:
            self._close_nearest(("p",), CELL_BOUNDARY)
        if tag in CELLS:
            self._close_nearest(CELLS, ("table", "tr"))
        elif tag == "tr":
            self._close_nearest(("tr",), ("table",))

    def _close_nearest(self, tags, boundary):
        for depth in range(len(self.open_tags) - 1, -1, -1):
            if self.open_tags[depth] in tags:
                self._close_down_to(depth)
                return
            if self.open_tags[depth] in boundary:
                return

    def _close_down_to(self, depth):
        self.open_count.subtract(self.open_tags[depth:])
        del self.open_tags[depth:]
        self.open_texts = [text for text in self.open_texts if text.depth < depth]
        self.open_rows = [entry for entry in self.open_rows if entry[0] < depth]
        for name, text in self.texts.items():
            if text.depth >= depth:
                self._settle(name)
        if self.heading_depth is not None and self.heading_depth >= depth:
            if self.sibling_depth is None:
                self.sibling_depth = self.heading_depth
        if self.sibling_depth is not None and depth < self.sibling_depth:
            self.sibling_depth = -1
            self._settle("description")
        if self.table_depth is not None and self.table_depth >= depth:
            self.table_depth = -1
            self._settle("specs")

    def _in_spec_table(self):
        return self.table_depth is not None and self.table_depth >= 0

    # texts

    def _open_text(self, depth):
        text = _Text(depth)
        self.open_texts.append(text)
        return text

    def _start_text(self, name, depth):
        if name not in self.texts and name not in self.settled:
            self.texts[name] = self._open_text(depth)

    def _settle(self, name):
        self.settled.add(name)
        if self.wanted <= self.settled:
            raise _Settled

    def fields(self) -> dict:
        found = {name: text.stripped() for name, text in self.texts.items()}
        found["star"] = self.star
        found["specs"] = [
            (row["th"].stripped(), row["td"].stripped())
            for row in self.rows
            if "th" in row and "td" in row
        ]
        return {name: found[name] for name in self.wanted if name in found}


def read_page(html: str, wanted=FIELDS) -> dict:
    """The wanted fields; what a page lacks is None, the rows of its specification
    table are pairs of texts, in order. Reading stops once all wanted fields are known."""
    reader = _PageReader(wanted)
    try:
        reader.feed(html)
        reader.close()
    except _Settled:
        pass
    return dict.fromkeys(FIELDS) | {"specs": []} | reader.fields()
