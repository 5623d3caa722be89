"""Tables in web pages, by a tokenizer and a stack of open tables instead of patterns over the text.

Comments, scripts, styles and text areas hold no cells; entities are read;
a table within a cell is a table of its own, whose text is not the cell's; end
tags that are missing are supplied as browsers do (a row ends the row
before, a cell the cell before, the end of the page everything), and cells that
span columns or rows fill all their places with their text.
"""

from __future__ import annotations

from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..ship import ship

# The largest spans that browsers take.
MOST_COLUMNS, MOST_ROWS = 1000, 65_534
#: Places that the spans of one table may fill besides its cells: a page can ask for 65 million with two numbers.
MOST_FILLED = 1_000_000
HIDDEN = frozenset(("script", "style", "textarea", "title", "template", "noscript"))


class _Table:
    def __init__(self, number: int, parent: int | None):
        self.number, self.parent = number, parent
        self.rows: list[list[tuple[str, int, int, bool]]] = []  # cells: text, columns, rows, header
        self.cell: list[str] | None = None
        self.shape = (1, 1, False)
        self.row_open = False

    def open_row(self) -> None:
        self.close_row()
        self.rows.append([])
        self.row_open = True

    def open_cell(self, columns: int, rows: int, header: bool) -> None:
        self.close_cell()
        if not self.row_open:
            self.open_row()
        self.cell, self.shape = [], (columns, rows, header)

    def close_cell(self) -> None:
        if self.cell is not None:
            self.rows[-1].append((" ".join(" ".join(self.cell).split()), *self.shape))
            self.cell = None

    def close_row(self) -> None:
        self.close_cell()
        self.row_open = False

    def grid(self) -> list[tuple[list[str], bool]]:
        """Rows with spans filled, and whether all cells of a row's own are headers."""
        out, hanging, filled = [], {}, 0  # hanging: column -> [rows left, text]
        for row in self.rows:
            line: list[str] = []

            def used(column: int) -> str | None:
                """The text that hangs into a place of this row, if any; it hangs a row less from here."""
                held = hanging.get(column)
                if held is None:
                    return None
                held[0] -= 1
                if not held[0]:
                    del hanging[column]
                return held[1]

            def pass_hanging() -> None:
                while (text := used(len(line))) is not None:
                    line.append(text)

            for text, columns, rows, _ in row:
                pass_hanging()
                left = max(0, MOST_FILLED - filled)
                columns = min(columns, 1 + left)
                rows = min(rows, len(self.rows), 1 + left // columns)
                filled += columns * rows - 1
                for _ in range(columns):
                    used(len(line))  # of cells that overlap the later one shows
                    if rows > 1:
                        hanging[len(line)] = [rows - 1, text]
                    line.append(text)
            last = max(hanging, default=-1)
            while len(line) <= last:
                if len(line) not in hanging:
                    line.append("")
                else:
                    pass_hanging()
                last = max((c for c in hanging if c >= len(line)), default=-1)
            out.append((line, bool(row) and all(h for *_, h in row)))
        return out


def _number(attributes: list, name: str, most: int, zero: int) -> int:
    text = dict(attributes).get(name) or ""
    digits = "".join(c for c in text.strip() if c.isascii() and c.isdigit())[:9]
    return zero if digits and int(digits) == 0 else max(1, min(int(digits or 1), most))


class _Reader(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.done: list[_Table] = []
        self.open: list[_Table] = []
        self.hidden = ""
        self.count = 0

    def handle_starttag(self, tag: str, attributes: list) -> None:
        if self.hidden:
            return
        if tag in HIDDEN:
            self.hidden = tag
        elif tag == "table":
            self.open.append(_Table(self.count, self.open[-1].number if self.open else None))
            self.count += 1
        elif self.open and tag == "tr":
            self.open[-1].open_row()
        elif self.open and tag in ("td", "th"):
            self.open[-1].open_cell(_number(attributes, "colspan", MOST_COLUMNS, 1), _number(attributes, "rowspan", MOST_ROWS, MOST_ROWS), tag == "th")

    def handle_startendtag(self, tag: str, attributes: list) -> None:
        self.handle_starttag(tag, attributes)  # in HTML a slash ends no element

    def handle_endtag(self, tag: str) -> None:
        if self.hidden:
            self.hidden = "" if tag == self.hidden else self.hidden
        elif not self.open:
            return
        elif tag == "table":
            table = self.open.pop()
            table.close_row()
            self.done.append(table)
        elif tag == "tr":
            self.open[-1].close_row()
        elif tag in ("td", "th"):
            self.open[-1].close_cell()

    def handle_data(self, data: str) -> None:
        if not self.hidden and self.open and self.open[-1].cell is not None:
            self.open[-1].cell.append(data)

    def tables(self, html: str) -> list[_Table]:
        self.feed(html)
        self.hidden = self.hidden if self.hidden in ("script", "style") else ""
        self.close()
        while self.open:
            self.handle_endtag("table")
        return sorted(self.done, key=lambda t: t.number)


def tables_of(html: str | None) -> list[tuple[int, int | None, list[tuple[list[str], bool]]]]:
    """(number, number of the table around it, rows) of the tables of a page, in the order in which they open."""
    return [(t.number, t.parent, t.grid()) for t in _Reader().tables(html)] if html else []


def page_tables(pages: DataFrame, html: str = "html", key: str = "page_id", batch: int = 5_000) -> DataFrame:
    """(key, table_no, parent_no, row_no, header, cells) of every table row in a column of web pages; numbers begin with 0.

    A page without tables, a null page and an empty table give no row; a repeated page gives its rows again.
    """
    spark = pages.sparkSession
    ship(spark)
    names = ["key", "table_no", "parent_no", "row_no", "header", "cells"]

    def read(batches):
        for pdf in batches:
            rows: list[tuple] = []
            for k, text in zip(pdf["key"].tolist(), pdf["html"]):
                for number, parent, grid in tables_of(text):
                    rows += [(k, number, -1 if parent is None else parent, n, header, cells) for n, (cells, header) in enumerate(grid)]
                while len(rows) >= batch:
                    yield pd.DataFrame(rows[:batch], columns=names)
                    rows = rows[batch:]
            if rows:
                yield pd.DataFrame(rows, columns=names)

    # Keys travel as text, which no null among numbers can turn into doubles.
    kind = pages.schema[key].dataType.simpleString()
    found = pages.select(F.col(f"`{key}`").cast("string").alias("key"), F.col(f"`{html}`").alias("html")).mapInPandas(read, "key string, table_no int, parent_no int, row_no int, header boolean, cells array<string>")
    return found.select(F.col("key").cast(kind).alias(key), "table_no", F.when(F.col("parent_no") >= 0, F.col("parent_no")).alias("parent_no"), "row_no", "header", "cells")
