"""Rows of one HTML table per page, as a distributed job over a column of pages.

For each page: find ``<table id=...>``, take the header cells of ``<thead>`` (empty header
cells are dropped), require them to equal the expected list, and emit each ``<tbody>`` row,
which must have exactly as many cells as there are output columns; cell text is trimmed.
A missing table, changed headers, a wrong cell count or no body rows is an error: raised
(``on_error='fail'``) or reported on a row with null cells (``on_error='quarantine'``).

HTML parsing has no native Spark expression, so pages are parsed in ``mapInPandas`` with
the standard-library parser; Spark distributes the pages, one page per parser call.
"""

from __future__ import annotations

import sys
from collections.abc import Sequence
from html.parser import HTMLParser

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame

# The per-page parser runs in Python workers. Shipping this module's code by value means the
# workers need neither this package installed nor it on their path (it only uses the
# standard library and pandas).
cloudpickle.register_pickle_by_value(sys.modules[__name__])


class _TableScan(HTMLParser):
    def __init__(self, table_id: str):
        super().__init__(convert_charrefs=True)
        self.table_id = table_id
        self.found = False
        self.depth = 0            # nesting depth of tables inside the target table
        self.section = None       # "thead" | "tbody"
        self.headers: list[str] = []
        self.rows: list[list[str]] = []
        self._cell: list[str] | None = None
        self._row: list[str] | None = None

    def handle_starttag(self, tag, attrs):
        if tag == "table":
            if self.depth:
                self.depth += 1
            elif not self.found and dict(attrs).get("id") == self.table_id:
                self.found, self.depth = True, 1
            return
        if self.depth != 1:
            return
        if tag in ("thead", "tbody"):
            self.section = tag
        elif tag == "tr" and self.section == "tbody":
            self._row = []
        elif tag in ("th", "td"):
            self._cell = []

    def handle_endtag(self, tag):
        if tag == "table" and self.depth:
            self.depth -= 1
            return
        if self.depth != 1:
            return
        if tag in ("th", "td") and self._cell is not None:
            text = "".join(self._cell).strip()
            if tag == "th" and self.section == "thead":
                self.headers.append(text)
            elif tag == "td" and self._row is not None:
                self._row.append(text)
            self._cell = None
        elif tag == "tr" and self._row is not None:
            self.rows.append(self._row)
            self._row = None
        elif tag in ("thead", "tbody"):
            self.section = None

    def handle_data(self, data):
        if self._cell is not None and self.depth == 1:
            self._cell.append(data)


def parse_table(html: str | None, table_id: str, expected_headers: Sequence[str],
                n_cells: int) -> tuple[list[list[str]], str | None]:
    """Rows of the table and an error message (None when the page is well formed)."""
    scan = _TableScan(table_id)
    scan.feed(html or "")
    scan.close()
    if not scan.found:
        return [], f"table#{table_id} not found"
    headers = [h for h in scan.headers if h]
    if headers != list(expected_headers):
        return [], f"table headers changed: {headers}"
    for r in scan.rows:
        if len(r) != n_cells:
            return [], f"row has {len(r)} cells: {r}"
    if not scan.rows:
        return [], "table contained no data rows"
    return scan.rows, None


def extract_html_table(pages: DataFrame, html_col: str, table_id: str,
                       expected_headers: Sequence[str], columns: Sequence[str],
                       id_col: str | None = None, on_error: str = "fail") -> DataFrame:
    """One output row per table body row: ``[id_col], row_number, *columns, error``."""
    if on_error not in ("fail", "quarantine"):
        raise ValueError("on_error must be 'fail' or 'quarantine'")
    keep = [id_col] if id_col else []
    id_type = dict(pages.dtypes)[id_col] if id_col else None
    schema = ", ".join(([f"`{id_col}` {id_type}"] if id_col else [])
                       + ["row_number int"] + [f"`{c}` string" for c in columns]
                       + ["error string"])
    n = len(columns)
    headers = list(expected_headers)

    def scan(batches):
        for pdf in batches:
            out = []
            for rec in pdf.itertuples(index=False):
                page = rec[1] if keep else rec[0]
                rows, err = parse_table(page, table_id, headers, n)
                ident = [rec[0]] if keep else []
                if err is not None:
                    if on_error == "fail":
                        raise ValueError(f"page {ident[0] if ident else ''}: {err}")
                    out.append(ident + [None] + [None] * n + [err])
                    continue
                for i, r in enumerate(rows, start=1):
                    out.append(ident + [i] + r + [None])
            yield pd.DataFrame(out, columns=keep + ["row_number", *columns, "error"])

    return pages.select(*keep, html_col).mapInPandas(scan, schema)
