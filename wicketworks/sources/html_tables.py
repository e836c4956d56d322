"""Statistics tables inside HTML pages."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from html.parser import HTMLParser
from typing import NamedTuple

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

EXTRACTED = "page BIGINT, stat_type STRING, row_no INT, header ARRAY<STRING>, cells ARRAY<STRING>"


# The largest spans that HTML knows.
_MOST_COLUMNS, _MOST_ROWS = 1000, 65534


class _Cell(NamedTuple):
    text: str
    head: bool
    columns: int
    rows: int


class _Row:
    """Cells of one row, and whether the row stands in the table's head."""

    def __init__(self, in_head: bool) -> None:
        self.in_head = in_head
        self.cells: list[_Cell] = []


class _Tables(HTMLParser):
    """Collects tables in document order as lists of rows."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.tables: list[list[_Row]] = []
        self.open: list[dict] = []

    def handle_starttag(self, tag, attrs):
        if tag == "table":
            rows: list[_Row] = []
            self.tables.append(rows)
            self.open.append({"rows": rows, "cell": None, "kind": None, "in_head": False})
        elif self.open:
            table = self.open[-1]
            if tag in ("thead", "tbody", "tfoot"):
                self._close_cell()
                table["in_head"] = tag == "thead"
            elif tag == "tr":
                self._close_cell()
                table["rows"].append(_Row(table["in_head"]))
            elif tag in ("td", "th"):
                self._close_cell()
                spans = dict(attrs)
                columns = _span(spans.get("colspan"), _MOST_COLUMNS)
                table["cell"], table["kind"] = [], (tag == "th", columns, _span(spans.get("rowspan"), _MOST_ROWS))

    def handle_endtag(self, tag):
        if not self.open:
            return
        if tag in ("td", "th", "tr", "thead"):
            self._close_cell()
            if tag == "thead":
                self.open[-1]["in_head"] = False
        elif tag == "table":
            self._close_cell()
            self.open.pop()

    def handle_data(self, data):
        if self.open and self.open[-1]["cell"] is not None:
            self.open[-1]["cell"].append(data)

    def _close_cell(self):
        table = self.open[-1]
        if table["cell"] is not None:
            if not table["rows"]:
                table["rows"].append(_Row(table["in_head"]))
            head, columns, rows = table["kind"]
            table["rows"][-1].cells.append(_Cell(" ".join("".join(table["cell"]).split()), head, columns, rows))
            table["cell"] = None


def _span(value: str | None, most: int) -> int:
    text = (value or "").strip()
    return min(max(int(text), 1), most) if text.isascii() and text.isdigit() else 1


def _grid(rows: list[_Row]) -> list[list[str]]:
    """Texts by row and column; a cell is repeated over the columns and rows that it spans."""
    out = []
    below: dict[int, tuple[str, int]] = {}  # column: text and rows that it still covers
    for row in rows:
        line: list[str] = []
        later: dict[int, tuple[str, int]] = {}

        def covered() -> None:
            while len(line) in below:
                text, left = below.pop(len(line))
                if left > 1:
                    later[len(line)] = (text, left - 1)
                line.append(text)

        for cell in row.cells:
            for _ in range(cell.columns):
                covered()
                if cell.rows > 1:
                    later[len(line)] = (cell.text, cell.rows - 1)
                line.append(cell.text)
        covered()
        below = {**below, **later}
        out.append(line)
    return out


def _parse(html: str) -> list[tuple[list[str], list[list[str]]]]:
    """(header, rows) of every table with text. Rows in the head are the header whatever their cells are, the last
    one naming the columns; without a head it is a first row of header cells.
    """
    parser = _Tables()
    parser.feed(html)
    parser.close()
    found = []
    for rows in parser.tables:
        rows = [r for r in rows if r.cells]
        if not any(cell.text for row in rows for cell in row.cells):
            continue
        lines = _grid(rows)
        heads = [i for i, row in enumerate(rows) if row.in_head]
        if not heads and all(cell.head for cell in rows[0].cells):
            heads = [0]
        first = lines[heads[-1]] if heads else []
        header = [text or f"Unnamed: {i}" for i, text in enumerate(first)]
        found.append((header, [line for i, line in enumerate(lines) if i not in heads]))
    return found


def extract_tables(pages: DataFrame, table_index: int = 2, min_rows: int = 2) -> DataFrame:
    """Rows of one table per (page, stat_type, html) row.

    A page has data when it holds more than ``table_index`` tables and the wanted one has at
    least ``min_rows`` rows. A page without data yields one row with null ``row_no``.
    """

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for page, stat_type, html in zip(batch["page"], batch["stat_type"], batch["html"]):
                tables = _parse(html or "")
                header, rows = tables[table_index] if len(tables) > table_index else ([], [])
                if len(rows) < min_rows:
                    header, rows, numbers = [], [None], [None]
                else:
                    numbers = list(range(len(rows)))
                yield pd.DataFrame(
                    {
                        "page": page,
                        "stat_type": stat_type,
                        "row_no": pd.array(numbers, dtype="Int32"),
                        "header": [header] * len(rows),
                        "cells": rows,
                    }
                )

    return pages.select("page", "stat_type", "html").mapInPandas(read, EXTRACTED)


def before_first_empty_page(rows: DataFrame) -> DataFrame:
    """Rows of the pages before the first page without data."""
    first_empty = rows.where(F.col("row_no").isNull()).agg(F.min("page")).scalar()
    return rows.where(F.col("row_no").isNotNull() & (first_empty.isNull() | (F.col("page") < first_empty)))


def skip_after_empty_type(rows: DataFrame, types: Sequence[str]) -> DataFrame:
    """On each page, drop the types that come after the first type without data.

    The marker row of that first empty type stays, so the pages can still be cut after it.
    """
    place = F.array_position(F.array(*[F.lit(t) for t in types]), F.col("stat_type"))
    placed = rows.withColumn("_place", place)
    stops = (
        placed.where(F.col("row_no").isNull())
        .groupBy("page")
        .agg(F.min("_place").alias("_stop"))
    )
    kept = placed.join(stops, "page", "left").where(
        F.col("_stop").isNull() | (F.col("_place") <= F.col("_stop"))
    )
    return kept.select(*rows.columns)


def scraped_rows(rows: DataFrame, types: Sequence[str]) -> DataFrame:
    """Both stopping rules: types after an empty one are skipped, and pages end where none has data."""
    kept = skip_after_empty_type(rows, types)
    first_empty = (
        kept.groupBy("page")
        .agg(F.count("row_no").alias("_rows"))
        .where(F.col("_rows") == 0)
        .agg(F.min("page"))
        .scalar()
    )
    return kept.where(F.col("row_no").isNotNull() & (first_empty.isNull() | (F.col("page") < first_empty)))


def table_columns(rows: DataFrame, names: Sequence[str]) -> DataFrame:
    """Cells picked by header name, as text columns; an absent name gives null."""

    def cell(name: str):
        at = F.array_position("header", name)
        return F.when(at > 0, F.try_element_at("cells", at.cast("int"))).alias(name)

    return rows.select("page", "stat_type", "row_no", *[cell(n) for n in names])


def drop_unnamed(df: DataFrame, column: str) -> DataFrame:
    """Drop a trailing unnamed column; nothing happens when it is absent."""
    return df.drop(column)
