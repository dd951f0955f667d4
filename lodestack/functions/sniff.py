"""Kind of a file by its name, then by its first bytes."""

from __future__ import annotations

import gzip
import io

from pyspark.sql import Column
from pyspark.sql import functions as F

# Suffixes by kind, longest first, suffixes of no table, and magic numbers.
SUFFIXES = (
    (".csv.gz", "csv.gz"), (".json.gz", "json.gz"), (".geojson.gz", "geojson.gz"), (".parquet", "parquet"), (".geojson", "geojson"), (".gpkg", "gpkg"), (".shp", "shapefile"), (".kml", "kml"),
    (".csv", "csv"), (".tsv", "tsv"), (".json", "json"), (".xlsx", "xlsx"), (".xls", "xls"), (".ods", "ods"), (".zip", "zip"), (".7z", "7z"),
)
NON_TABULAR = (
    ".jpg", ".jpeg", ".png", ".gif", ".webp", ".pdf", ".doc", ".docx", ".ppt", ".pptx", ".txt", ".md", ".rtf", ".nc", ".tif", ".tiff", ".asc",
    ".qml", ".sld", ".lyr", ".lyrx", ".prj", ".cpg", ".dbf", ".shx", ".sbn", ".sbx", ".xml", ".dxf",
)
MAGIC = (
    ("parquet", b"PAR1"), ("zip", b"PK\x03\x04"), ("zip", b"PK\x05\x06"), ("7z", b"7z\xbc\xaf\x27\x1c"), ("rar", b"Rar!\x1a\x07"), ("bzip2", b"BZh"),
    ("sqlite", b"SQLite format 3\x00"), ("shapefile", b"\x00\x00\x27\x0a"), ("gzip", b"\x1f\x8b"),
)
HEAD = 65536


def by_suffix(path: Column) -> Column:
    """Kind by suffix, null if the suffix says nothing. SpreadsheetML in .xml files is left to the bytes."""
    name = F.lower(F.element_at(F.split(path, "/"), -1))
    out = None
    for suffix, kind in SUFFIXES:
        out = (F if out is None else out).when(name.endswith(suffix), F.lit(kind))
    for suffix in NON_TABULAR:
        if suffix != ".xml":
            out = out.when(name.endswith(suffix), F.lit("non-tabular"))
    return out


def by_magic(content: Column) -> Column:
    """Kind by the first bytes (binary)."""
    out = None
    for kind, magic in MAGIC:
        out = (F if out is None else out).when(F.substring(content, 1, len(magic)) == F.lit(magic), F.lit(kind))
    text = F.regexp_replace(F.decode(F.substring(content, 1, HEAD), "ISO-8859-1"), r"^[ \t\n\r\x0b\x0c]+", "")
    return out.otherwise(by_text(text))


def by_text(text: Column) -> Column:
    """Kind of stripped text: spreadsheetml, text/xml, json or unknown."""
    probe = F.lower(text)
    sheet = probe.contains("urn:schemas-microsoft-com:office:spreadsheet") | probe.contains("<workbook")
    return F.when(text.startswith("<") & sheet, "spreadsheetml").when(text.startswith("<"), "text/xml").when(text.startswith("{") | text.startswith("["), "json").otherwise("unknown")


def kind(path: Column, content: Column) -> Column:
    found = F.coalesce(by_suffix(path), by_magic(content))
    plain_xml = (found == "text/xml") & F.lower(path).endswith(".xml")
    return F.when(plain_xml, "non-tabular").otherwise(found)


def payload(data: bytes) -> str:
    """Kind of gzipped bytes by what they hold: json.gz, csv.gz (a delimiter in the first line), or gzip."""
    try:
        with gzip.open(io.BytesIO(data)) as f:
            start = f.read(256 << 10)
    except (OSError, EOFError):
        return "gzip"
    if start.lstrip()[:1] in (b"{", b"["):
        return "json.gz"
    lines = start.decode("utf-8-sig", "replace").splitlines()
    return "csv.gz" if lines and any(d in lines[0] for d in ";,\t|") else "gzip"


def json_layout(text: Column) -> Column:
    """array, lines (several objects), object, empty or unknown, by the first characters.

    JSON Lines that begin with an object are told from one object by a line end between objects.
    """
    s = F.regexp_replace(text, r"^[\s\x{FEFF}]+", "")
    lines = s.rlike(r"^\{[^\n]*\}[ \t\r]*\n\s*\{")
    return F.when(s == "", "empty").when(s.startswith("["), "array").when(lines, "lines").when(s.startswith("{"), "object").otherwise("unknown")
