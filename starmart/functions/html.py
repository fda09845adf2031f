"""Table rows out of HTML text, as a vectorised column function."""

from __future__ import annotations

from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

# HTML elements that never have an end tag, and those whose text is not page text.
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta",
        "source", "track", "wbr"}
NOT_TEXT = {"script", "style", "template"}
# What a start tag ends if it is still open, and the elements beyond which it does not look.
IMPLIED_END = {"td": ({"td", "th"}, {"table"}), "th": ({"td", "th"}, {"table"}),
               "tr": ({"td", "th", "tr"}, {"table"}), "li": ({"li"}, {"ul", "ol", "menu"})}


class _RowReader(HTMLParser):
    """Gathers the cell texts of each row of each container while the page streams by.

    A cell belongs to every open row, a row to every open container, and text to every
    open cell, so that nested tables come out once per level. End tags that HTML lets a page
    leave out are implied: a cell ends where the next cell or row of its table begins.
    """

    def __init__(self, container, css_class, row, cells, sep):
        super().__init__(convert_charrefs=True)
        self.container, self.css_class = container, css_class
        self.row, self.cells, self.sep = row, cells, sep
        self.open = []  # (tag, kind, collected parts) from the outermost element inwards
        self.tables = []
        self.pending = []

    def _inner(self, kind):
        return [parts for _, k, parts in self.open if k == kind]

    def _end_text(self):
        piece = "".join(self.pending).strip()
        self.pending = []
        if piece and not (self.open and self.open[-1][0] in NOT_TEXT):
            for parts in self._inner("cell"):
                parts.append(piece)

    def _end_implied(self, tag):
        ends, beyond = IMPLIED_END.get(tag, ((), ()))
        first = None
        for i in range(len(self.open) - 1, -1, -1):
            name, kind, _ = self.open[i]
            if name in beyond or kind == "container":
                break
            if name in ends:
                first = i
        if first is not None:
            del self.open[first:]

    def handle_starttag(self, tag, attrs):
        self._end_text()
        self._end_implied(tag)
        kind, parts = None, []
        if tag == self.container and self._has_class(attrs):
            kind = "container"
            self.tables.append(parts)
        elif tag == self.row and self._inner("container"):
            kind = "row"
            for rows in self._inner("container"):
                rows.append(parts)
        elif tag in self.cells and self._inner("row"):
            kind = "cell"
            for cells in self._inner("row"):
                cells.append(parts)
        if tag not in VOID:
            self.open.append((tag, kind, parts))

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        self.handle_endtag(tag)

    def handle_endtag(self, tag):
        self._end_text()
        for i in range(len(self.open) - 1, -1, -1):
            if self.open[i][0] == tag:
                del self.open[i:]
                return

    def handle_data(self, data):
        self.pending.append(data)

    def handle_comment(self, data):
        self._end_text()

    def _has_class(self, attrs):
        if self.css_class is None:
            return True
        return self.css_class in (dict(attrs).get("class") or "").split()

    def result(self):
        return [[[self.sep.join(cell) for cell in row] for row in rows] for rows in self.tables]


def html_rows(html: Column, container="div", css_class="table-container", row="tr",
              cells=("th", "td"), sep="") -> Column:
    """``array<array<array<string>>>``: containers, their rows, the text of their cells.

    Within a cell the pieces of text are stripped and joined with ``sep``. Only the page
    text itself travels to Python, one Arrow batch at a time.
    """
    wanted = tuple(cells)

    @F.pandas_udf("array<array<array<string>>>")
    def read(pages: pd.Series) -> pd.Series:
        out = []
        for page in pages:
            reader = _RowReader(container, css_class, row, wanted, sep)
            reader.feed(page or "")
            reader.close()
            reader._end_text()
            out.append(reader.result())
        return pd.Series(out, dtype=object)

    return read(html)
