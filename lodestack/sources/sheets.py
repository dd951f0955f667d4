"""Spreadsheets: XLSX and ODS by their XML, SpreadsheetML, HTML tables and delimited text under a sheet's name."""

from __future__ import annotations

import csv
import html.parser
import io
import json
import re
import xml.etree.ElementTree as ET
import zipfile
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestack.sources.files import encoding_of

#: Larger workbooks are refused rather than held in memory.
MOST_BYTES = 128 << 20


def engine(data: bytes) -> str:
    """xlsx, ods, xls, spreadsheetml, html or text, by the bytes."""
    if data[:4] == b"PK\x03\x04":
        with zipfile.ZipFile(io.BytesIO(data)) as z:
            names = set(z.namelist())
        return "ods" if "content.xml" in names else "xlsx"
    if data[:8] == bytes.fromhex("d0cf11e0a1b11ae1"):
        return "xls"
    start = data[:65536].lower().lstrip()
    if start.startswith(b"<"):
        return "spreadsheetml" if b"urn:schemas-microsoft-com:office:spreadsheet" in start or b"<workbook" in start else "html"
    return "text"


def _tag(e: ET.Element) -> str:
    return e.tag.rsplit("}", 1)[-1]


def _attribute(e: ET.Element, name: str) -> str | None:
    return next((v for k, v in e.attrib.items() if k.rsplit("}", 1)[-1] == name), None)


def _column(reference: str) -> int:
    out = 0
    for c in re.match("[A-Z]*", reference)[0]:
        out = out * 26 + ord(c) - 64
    return out - 1


def _xlsx(data: bytes) -> Iterator[tuple[str, list[str | None]]]:
    with zipfile.ZipFile(io.BytesIO(data)) as z:
        names = z.namelist()
        shared = []
        if "xl/sharedStrings.xml" in names:
            for si in ET.fromstring(z.read("xl/sharedStrings.xml")):
                shared.append("".join(t.text or "" for t in si.iter() if _tag(t) == "t"))
        targets = {r.get("Id"): r.get("Target", "") for r in ET.fromstring(z.read("xl/_rels/workbook.xml.rels"))}
        for sheet in ET.fromstring(z.read("xl/workbook.xml")).iter():
            if _tag(sheet) != "sheet":
                continue
            target = targets[_attribute(sheet, "id")].lstrip("/")
            for row in ET.fromstring(z.read(target if target.startswith("xl/") else f"xl/{target}")).iter():
                if _tag(row) != "row":
                    continue
                cells: dict[int, str | None] = {}
                for c in row:
                    at = _column(c.get("r", "")) if c.get("r") else len(cells)
                    text = next((x.text for x in c if _tag(x) == "v"), None)
                    kind = c.get("t")
                    if kind == "s" and text is not None:
                        text = shared[int(text)]
                    elif kind == "inlineStr":
                        text = "".join(t.text or "" for t in c.iter() if _tag(t) == "t")
                    elif kind == "b" and text is not None:
                        text = "TRUE" if text == "1" else "FALSE"
                    cells[at] = text
                yield sheet.get("name", ""), [cells.get(k) for k in range(max(cells, default=-1) + 1)]


def _ods(data: bytes) -> Iterator[tuple[str, list[str | None]]]:
    with zipfile.ZipFile(io.BytesIO(data)) as z:
        root = ET.fromstring(z.read("content.xml"))
    for table in root.iter():
        if _tag(table) != "table":
            continue
        for row in table.iter():
            if _tag(row) != "table-row":
                continue
            cells: list[str | None] = []
            gap = 0
            for c in row:
                if _tag(c) not in ("table-cell", "covered-table-cell"):
                    continue
                text = "\n".join("".join(p.itertext()) for p in c if _tag(p) == "p") or _attribute(c, "value")
                times = int(_attribute(c, "number-columns-repeated") or 1)
                if text:
                    cells += [None] * gap + [text] * min(times, 16384)
                    gap = 0
                else:  # a run at the end of the row is dropped
                    gap += times
            times = int(_attribute(row, "number-rows-repeated") or 1) if cells else 1
            for _ in range(times):
                yield _attribute(table, "name") or "", cells


def _spreadsheetml(data: bytes) -> Iterator[tuple[str, list[str | None]]]:
    for sheet in ET.fromstring(data).iter():
        if _tag(sheet) != "Worksheet":
            continue
        for row in sheet.iter():
            if _tag(row) != "Row":
                continue
            cells: list[str | None] = []
            for c in row:
                if _tag(c) == "Cell":
                    at = int(_attribute(c, "Index") or len(cells) + 1)
                    cells += [None] * (at - 1 - len(cells))
                    cells.append(next(("".join(d.itertext()) for d in c if _tag(d) == "Data"), None))
            yield _attribute(sheet, "Name") or "", cells


class _Tables(html.parser.HTMLParser):
    def __init__(self):
        super().__init__()
        self.rows: list[tuple[int, list[str | None]]] = []
        self.table, self.row, self.cell = -1, None, None

    def handle_starttag(self, tag, attrs):
        if tag == "table":
            self.table += 1
        elif tag == "tr":
            self._end_row()
            self.row = []
        elif tag in ("td", "th") and self.row is not None:
            self._end_cell()
            self.cell = []

    def handle_endtag(self, tag):
        if tag in ("td", "th"):
            self._end_cell()
        elif tag in ("tr", "table"):
            self._end_row()

    def handle_data(self, data):
        if self.cell is not None:
            self.cell.append(data)

    def _end_cell(self):
        if self.cell is not None and self.row is not None:
            self.row.append(" ".join("".join(self.cell).split()) or None)
        self.cell = None

    def _end_row(self):
        self._end_cell()
        if self.row:
            self.rows.append((self.table, self.row))
        self.row = None


def html_tables(text: str) -> list[tuple[int, list[str | None]]]:
    """(number of the table, cells) of each table row of a page."""
    parser = _Tables()
    parser.feed(text)
    parser.close()
    parser._end_row()
    return parser.rows


def sheet_rows(data: bytes) -> Iterator[tuple[str, list[str | None]]]:
    """(sheet, cells as text) of every row of a workbook."""
    if len(data) > MOST_BYTES:
        raise ValueError(f"workbook of {len(data)} bytes; at most {MOST_BYTES} are read")
    kind = engine(data)
    if kind == "xlsx":
        yield from _xlsx(data)
    elif kind == "ods":
        yield from _ods(data)
    elif kind == "spreadsheetml":
        yield from _spreadsheetml(data)
    elif kind == "xls":
        import pandas as pd  # needs the optional xlrd package

        for name, frame in pd.read_excel(io.BytesIO(data), sheet_name=None, header=None, dtype=str, engine="xlrd").items():
            for row in frame.itertuples(index=False):
                yield str(name), [None if pd.isna(v) else str(v) for v in row]
    else:
        text = data.decode(encoding_of(data[: 1 << 20]), "replace")
        if kind == "html":
            for table, cells in html_tables(text):
                yield f"table-{table}", cells
        else:
            first = text.splitlines()[0] if text else ""
            delimiter = max(",;\t|", key=first.count)  # the first of equals
            for row in csv.reader(io.StringIO(text, newline=""), delimiter=delimiter):
                yield "sheet", [v or None for v in row]


def read_sheets(spark: SparkSession, path: str) -> DataFrame:
    """file, sheet, row_number from 1, row_json: every row of every sheet, cells as text; a task reads a file."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                seen: dict[str, int] = {}
                rows = []
                for sheet, cells in sheet_rows(data):
                    seen[sheet] = seen.get(sheet, 0) + 1
                    rows.append((name, sheet, seen[sheet], json.dumps(cells, ensure_ascii=False, separators=(",", ":"))))
                columns = [pa.array([r[k] for r in rows], t) for k, t in enumerate((pa.string(), pa.string(), pa.int64(), pa.string()))]
                yield pa.RecordBatch.from_arrays(columns, ["file", "sheet", "row_number", "row_json"])

    files = spark.read.format("binaryFile").load(path).select("path", "content")
    return files.mapInArrow(run, "file string, sheet string, row_number long, row_json string")


def tables(spark: SparkSession, path: str) -> list[tuple[str, DataFrame]]:
    """Each sheet of one file as a table of strings: names from its first row, then a row each.

    A name that is empty or was there before gets its column's number. A sheet of one row has no rows.
    """
    rows = read_sheets(spark, path)
    sizes = rows.groupBy("sheet").agg(F.max(F.json_array_length("row_json")).alias("width"), F.max(F.when(F.col("row_number") == 1, F.col("row_json"))).alias("head"))
    out = []
    for r in sizes.orderBy("sheet").collect():  # one row a sheet
        names: list[str] = []
        for k, name in enumerate((json.loads(r["head"]) + [None] * r["width"])[: r["width"]]):
            names.append(name if name and name.lower() not in {n.lower() for n in names} else f"{name or 'column'}.{k + 1}")
        cells = F.from_json("row_json", "array<string>")
        body = rows.filter((F.col("sheet") == r["sheet"]) & (F.col("row_number") > 1)).select(cells.alias("c"))
        out.append((r["sheet"], body.select(*[F.get("c", F.lit(k)).alias(n) for k, n in enumerate(names)])))
    return out
