"""HTML tables and cell matrices with merge marks. Tree-shaped input, so Arrow-batched functions.

A matrix is a table without spans in which a cell holds ``<l>`` if it is merged into the cell on its left, ``<t>`` into
the one above, ``<lt>`` into both.
"""

from __future__ import annotations

from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from sparkloom.ship import ship

MARKS = ("l", "t", "lt")


class TableShapeError(ValueError):
    """Rows or spans that do not make a rectangle."""


class _Cells(HTMLParser):
    """Rows of (text or mark, rowspan, colspan) of the first table."""

    def __init__(self) -> None:
        super().__init__()
        self.rows: list[list[list]] = []
        self.tables = 0
        self.inside = False
        self.mark: str | None = None
        self.text: list[str] = []

    def handle_starttag(self, tag, attrs):
        if tag == "table":
            self.tables += 1
        if self.tables != 1:
            return
        if tag == "tr":
            self.rows.append([])
        elif tag == "td" and self.rows:
            self.inside, self.mark, self.text = True, None, []
            spans = dict(attrs)
            self.rows[-1].append(["", int(spans.get("rowspan") or 1), int(spans.get("colspan") or 1)])
        elif self.inside and tag in MARKS and self.mark is None:
            self.mark = f"<{tag}>"

    def handle_endtag(self, tag):
        if tag == "td" and self.inside:
            self.rows[-1][-1][0] = self.mark or "".join(self.text)
            self.inside = False

    def handle_data(self, data):
        if self.inside:
            self.text.append(data.strip())


def cells(html: str) -> list[list[tuple[str, int, int]]] | None:
    parser = _Cells()
    parser.feed(html)
    parser.close()
    return [[tuple(c) for c in row] for row in parser.rows] if parser.tables else None


def matrix_to_html(matrix: str) -> str:
    """Merge marks become rowspan and colspan."""
    rows = cells(matrix)
    if rows is None or len({len(r) for r in rows}) > 1:
        raise TableShapeError("rows differ in length")
    grid = [[c[0] for c in row] for row in rows]
    height, width = len(grid), len(grid[0]) if grid else 0
    used = [[False] * width for _ in range(height)]
    out = ["<table>"]
    for r in range(height):
        out.append("<tr>")
        for c in range(width):
            if used[r][c]:
                continue
            if grid[r][c] in ("<l>", "<t>", "<lt>"):
                raise TableShapeError("a mark has no cell to belong to")
            down = next((i for i in range(r + 1, height) if used[i][c] or grid[i][c] != "<t>"), height) - r
            right = next((j for j in range(c + 1, width) if used[r][j] or grid[r][j] != "<l>"), width) - c
            for i in range(r, r + down):
                for j in range(c, c + right):
                    if i > r and j > c and (used[i][j] or grid[i][j] != "<lt>"):
                        raise TableShapeError("a merged block is not a rectangle")
                    used[i][j] = True
            spans = (f' rowspan="{down}"' if down > 1 else "") + (f' colspan="{right}"' if right > 1 else "")
            out.append(f"<td{spans}>{grid[r][c]}</td>")
        out.append("</tr>")
    return "".join(out) + "</table>"


def html_to_matrix(html: str) -> str:
    """Spans become merge marks."""
    rows = cells(html)
    if not rows:
        raise TableShapeError("no rows")
    height, width = len(rows), sum(c[2] for c in rows[0])
    grid: list[list[str | None]] = [[None] * width for _ in range(height)]
    for r, row in enumerate(rows):
        for text, down, right in row:
            c = next((j for j, x in enumerate(grid[r]) if x is None), None)
            if c is None or c + right > width or r + down > height:
                raise TableShapeError("a cell does not fit")
            for i in range(down):
                for j in range(right):
                    if grid[r + i][c + j] is not None:
                        raise TableShapeError("cells overlap")
                    grid[r + i][c + j] = text if not i and not j else f"<{'t' if not j else 'l' if not i else 'lt'}>"
    if any(x is None for row in grid for x in row):
        raise TableShapeError("a row is too short")
    return "<table>" + "".join("<tr>" + "".join(f"<td>{x}</td>" for x in row) + "</tr>" for row in grid) + "</table>"


def _apply(text: Column, convert, tolerant: bool) -> Column:
    ship()

    def fragment(part: str) -> str:
        if cells(part) is None:
            return part
        try:
            return convert(part)
        except TableShapeError:
            if tolerant:
                return part
            raise

    @F.pandas_udf("string")
    def run(values: pd.Series) -> pd.Series:
        return values.map(lambda t: None if t is None else "\n\n".join(fragment(p) for p in t.split("\n\n")))

    return run(text)


def tables_to_html(markdown: Column, tolerant: bool = False) -> Column:
    """Every fragment between empty lines that holds a table is converted; bad tables raise unless ``tolerant``."""
    return _apply(markdown, matrix_to_html, tolerant)


def tables_to_matrix(markdown: Column, tolerant: bool = False) -> Column:
    return _apply(markdown, html_to_matrix, tolerant)
