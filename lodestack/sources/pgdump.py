"""PostgreSQL dumps: an index of COPY blocks, and a data source that reads them by byte ranges.

The dump is a plain `.sql` file, or one member of a tar, gzipped or not. Scanning it once gives a catalog:
tables, columns, declared types, geometries and byte ranges. An uncompressed dump is scanned in
parallel: tasks find lines that may be control lines or ends of rows in their bytes, and the
driver puts these few in order. Its rows are read in parallel too, cut at row starts that the
scan noted; a gzipped dump can't be entered in the middle, so it is one partition, or is
unpacked first.
"""

from __future__ import annotations

import gzip
import json
import re
import tarfile
from collections.abc import Iterator
from dataclasses import asdict, dataclass
from itertools import islice
from typing import Any, BinaryIO

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, InputPartition

from lodestack.functions import copytext, pgtypes
from lodestack.sources.files import identity, open_bytes

# The grammar of a dump's control lines.
ALTER = re.compile(r'ALTER TABLE\s+"([^"]+)"\."([^"]+)"\s+ADD COLUMN\s+"([^"]+)"\s+(.+);', re.I)
COPY = re.compile(r'COPY\s+"([^"]+)"\."([^"]+)"\s*\((.*)\)\s+FROM STDIN;', re.I)
_QUOTED = r"'\s*([^']+?)\s*'"
GEOMETRY = re.compile(rf"SELECT\s+AddGeometryColumn\({_QUOTED},{_QUOTED},{_QUOTED},\s*(\d+)\s*,{_QUOTED},\s*(\d+)\s*\);", re.I)
COLUMN = re.compile(r'\s*(?:"((?:[^"]|"")*)"|([^",]*?))\s*(,|$)')
CHUNK = 1 << 20
#: Rows of an Arrow batch.
BATCH = 10_000
#: Bytes of rows a partition, about.
SPLIT = 128 << 20


@dataclass(frozen=True)
class Geometry:
    name: str
    geometry_type: str
    srid: int
    dimensions: int


def split_columns(text: str) -> list[str]:
    """Names of a COPY column list; quotes in quoted names are doubled."""
    out, at = [], 0
    while text[at:].strip():
        m = COLUMN.match(text, at)
        if m is None:
            raise ValueError(f"malformed COPY column list near {text[at : at + 30]!r}")
        out.append(m[1].replace('""', '"') if m[1] is not None else m[2])
        at = m.end()
    return out


def parse_control(line: str) -> tuple[str, tuple] | None:
    """A control line as ("column" | "geometry" | "copy", values), or None."""
    line = line.rstrip("\r\n")
    if m := ALTER.fullmatch(line):
        return "column", (m[1], m[2], m[3], pgtypes.declared_type(m[4]))
    if m := GEOMETRY.fullmatch(line):
        return "geometry", (m[1], m[2], Geometry(m[3], m[5], int(m[4]), int(m[6])))
    if m := COPY.fullmatch(line):
        return "copy", (m[1], m[2], split_columns(m[3]))
    return None


def physical_lines(stream: BinaryIO) -> Iterator[tuple[int, bytes]]:
    """(offset, line with its end), read in chunks."""
    at, rest = 0, b""
    while chunk := stream.read(CHUNK):
        lines = (rest + chunk).split(b"\n")
        rest = lines.pop()
        for x in lines:
            yield at, x + b"\n"
            at += len(x) + 1
    if rest:
        yield at, rest


def ends_copy(line: bytes) -> bool:
    return line.rstrip(b"\r\n") == b"\\."


def goes_on(line: bytes) -> bool:
    """An odd number of backslashes before the line end: the row has a line end in a value."""
    body = line.rstrip(b"\n")
    return line.endswith(b"\n") and (len(body) - len(body.rstrip(b"\\"))) % 2 == 1


#: Lines that may be control lines, wherever they stand.
CONTROL = re.compile(rb"^(?:COPY|ALTER|SELECT)\b[^\n]*\n?", re.I | re.M)
END = re.compile(rb"^\\\.\r?(?:\n|\Z)", re.M)
GOES_ON = re.compile(rb"(\\+)\n")
Fact = tuple[str, int, int, str, int]


def facts(stream: BinaryIO, first: int, stop: int | None, split: int, inside: bool = False) -> Iterator[Fact]:
    """(kind, offset, end, text, rows before it here) of lines of the text from first to stop: `control` lines,
    `end` (a terminator), and a `row` about every quarter of split, of lines that begin a row; last `total`.

    stream stands at first, which begins a line; stop ends one. A line begins a row unless the line
    before it goes on (inside: that before the first does). Whole lines are scanned at once, CHUNK bytes or more.
    """
    rest, at, seen, noted = b"", first, 0, None
    while True:
        chunk = stream.read(CHUNK if stop is None else max(0, min(CHUNK, stop - at - len(rest))))
        data = rest + chunk
        cut = data.rfind(b"\n") + 1 if chunk else len(data)
        block, rest = data[:cut], data[cut:]
        # beginnings of lines that don't begin a row, as they follow one that goes on
        inner = {m.end() for m in GOES_ON.finditer(block) if len(m[1]) % 2} | ({0} if inside and block else set())
        inside = cut in inner if block else inside
        inner.discard(cut)
        marks = [(m.start(), "control", m) for m in CONTROL.finditer(block)] + [(m.start(), "end", m) for m in END.finditer(block)]
        before = place = k = 0
        order = sorted(inner)
        for start, kind, m in sorted(marks, key=lambda x: x[0]):
            if start in inner:
                continue
            before += block.count(b"\n", place, start)
            place = start
            while k < len(order) and order[k] < start:
                k += 1
            yield kind, at + start, at + m.end(), m[0].decode("utf-8", "replace") if kind == "control" else "", seen + before - k
        x = 0
        while x < cut:
            wait = 0 if noted is None else noted + split // 4 - (at + x)
            if wait <= 0 and x not in inner:
                yield "row", at + x, at + x, "", 0
                noted, wait = at + x, split // 4
            x = block.find(b"\n", x + max(0, wait - 1)) + 1 or cut
        seen += block.count(b"\n") + (block != b"" and not block.endswith(b"\n")) - len(inner)
        at += cut
        if not chunk:
            yield "total", at, at, "", seen
            return


def assembled(found: list[Fact], tar_data_offset: int, split: int) -> dict[str, Any]:
    """The catalog from a dump's facts in order of offset, rows counted from its beginning.

    What looks like a control line within the rows of a table is a row.
    """
    types: dict[tuple, dict[str, str]] = {}
    geometries: dict[tuple, dict[str, Geometry]] = {}
    tables: list[dict[str, Any]] = []
    copying: dict[str, Any] | None = None
    for kind, offset, end, text, before in found:
        if copying is not None:
            if kind == "row" and offset > copying["starts"][-1] and offset - copying["starts"][-1] >= split:
                copying["starts"].append(offset)
            elif kind == "end":
                rows = before - copying.pop("before") - 1
                starts = [x for x in copying.pop("starts") if x < offset]
                tables.append({**copying, "range_size": end - copying["sql_offset"], "rows": rows, "starts": starts if rows else []})
                copying = None
            continue
        if kind != "control" or (control := parse_control(text)) is None:
            continue
        name, values = control
        key = values[:2]
        if name == "column":
            types.setdefault(key, {})[values[2]] = values[3]
        elif name == "geometry":
            geometries.setdefault(key, {})[values[2].name] = values[2]
        else:
            copying = {
                "schema": key[0], "table": key[1], "columns": values[2], "pg_types": dict(types.get(key, {})), "geometries": {n: asdict(g) for n, g in geometries.get(key, {}).items()},
                "sql_offset": offset, "tar_offset": tar_data_offset + offset, "before": before, "starts": [end],
            }
    if copying is not None:
        raise EOFError(f"the dump ends within the rows of {(copying['schema'], copying['table'])}")
    return {"version": 1, "tar_data_offset": tar_data_offset, "tables": tables}


def scan(stream: BinaryIO, tar_data_offset: int = 0, split: int = SPLIT) -> dict[str, Any]:
    """Catalog of a dump: tables with columns, types, geometries, byte ranges, rows and row starts.

    A range begins at the COPY line and ends after the terminator. starts are offsets of rows, about
    every `split` bytes, at which reading can begin.
    """
    return assembled(sorted(facts(stream, 0, None, split), key=lambda f: (f[1], f[0])), tar_data_offset, split)


def line_start(stream: BinaryIO, at: int, size: int) -> tuple[int, bool]:
    """Where the first line from offset at on begins, and whether it goes on from the one before."""
    if not at:
        return 0, False
    stream.seek(at - 1)
    while True:
        chunk = stream.read(CHUNK)
        k = chunk.find(b"\n")
        if k >= 0:
            break
        at += len(chunk)
        if not chunk:
            return size, False
    begin = at + k
    back = min(begin - 1, 1 << 12)
    while True:
        stream.seek(begin - 1 - back)
        tail = stream.read(back)
        run = len(tail) - len(tail.rstrip(b"\\"))
        if run < back or back == begin - 1:
            return begin, run % 2 == 1
        back = min(begin - 1, back * 16)


def open_dump(path: str, member: str | None = None) -> tuple[BinaryIO, int]:
    """Stream of the SQL text, and its offset in the tar (0 outside one).

    Without a member's name, a tar must hold exactly one `.sql` member.
    """
    raw = open_bytes(path)
    gzipped = raw.read(2) == b"\x1f\x8b"
    raw.seek(0)
    stream = gzip.open(raw, "rb") if gzipped else raw
    start = stream.read(512)
    stream.seek(0)
    if len(start) < 265 or start[257:262] != b"ustar":
        return stream, 0  # type: ignore[return-value]
    tar = tarfile.open(fileobj=stream, mode="r:")
    for info in tar:
        if info.isfile() and (info.name == member if member else info.name.endswith(".sql")):
            return tar.extractfile(info), info.offset_data  # type: ignore[return-value]
    raise FileNotFoundError(f"no SQL member in {path}")


#: Bytes that a task scans, and those up to which a dump is scanned where it is asked for.
SCANNED = 256 << 20


def build_catalog(path: str, member: str | None = None, split: int = SPLIT, spark: SparkSession | None = None, scanned: int = SCANNED) -> dict[str, Any]:
    """The catalog of a dump. With spark, an uncompressed one of more than `scanned` bytes is scanned by tasks."""
    stream, offset = open_dump(path, member)
    with stream:
        plain = not _gzipped(path)
        size = _text_size(path, member, offset) if plain and spark is not None else 0
        found = scan(stream, offset, split) if size <= scanned else _parallel(spark, path, offset, size, split, scanned)
    return {**found, "source": identity(path), "member": member}


def _gzipped(path: str) -> bool:
    with open_bytes(path) as f:
        return f.read(2) == b"\x1f\x8b"


def _text_size(path: str, member: str | None, offset: int) -> int:
    if not offset:
        return identity(path)["size"]
    with open_bytes(path) as f:
        return next(i.size for i in tarfile.open(fileobj=f, mode="r:") if i.offset_data == offset)


class _Section:
    """size bytes of a stream from offset on, as a stream of their own."""

    def __init__(self, stream: BinaryIO, offset: int, size: int):
        self.stream, self.offset, self.size, self.at = stream, offset, size, 0

    def seek(self, at: int) -> None:
        self.at = at

    def read(self, n: int) -> bytes:
        self.stream.seek(self.offset + self.at)
        out = self.stream.read(max(0, min(n, self.size - self.at)))
        self.at += len(out)
        return out


def _parallel(spark: SparkSession, path: str, offset: int, size: int, split: int, scanned: int) -> dict[str, Any]:
    """scan by ranges of bytes: the driver gets what may be control lines, ends and some row starts."""
    bounds = list(range(0, size, scanned))
    schema = "part int, kind string, at long, until long, text string, n long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, low in zip(*(c.to_pylist() for c in batch.columns)):
                with open_bytes(path) as raw:
                    section = _Section(raw, offset, size)
                    first, inside = line_start(section, low, size)
                    stop, _ = line_start(section, low + scanned, size) if low + scanned < size else (size, False)
                    section.seek(first)
                    rows = [(part, *f) for f in facts(section, first, max(first, stop), split, inside)]
                kinds = (pa.int32(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], [x.split()[0] for x in schema.split(", ")])

    parts = spark.createDataFrame(list(enumerate(bounds)), "part int, low long").repartitionByRange(len(bounds), "part")
    found = [tuple(r) for r in parts.mapInArrow(run, schema).collect()]
    base, total = {}, 0
    for part, *_, n in sorted(f for f in found if f[1] == "total"):
        base[part], total = total, total + n
    return assembled(sorted(((k, a, u, t, n + base[p]) for p, k, a, u, t, n in found if k != "total"), key=lambda f: (f[1], f[0])), offset, split)


def unpack(path: str, target: str, member: str | None = None) -> str:
    """The SQL text of a gzipped or archived dump as a plain file, whose ranges can be read in parallel."""
    import os
    import shutil

    stream, _ = open_dump(path, member)
    with stream, open(target + ".tmp", "wb") as out:
        shutil.copyfileobj(stream, out, CHUNK)
    os.replace(target + ".tmp", target)
    return target


def save_catalog(catalog: dict[str, Any], path: str) -> None:
    from lodestack.sources.files import atomic_json

    atomic_json(path, catalog)


def load_catalog(path: str, source: str | None = None) -> dict[str, Any]:
    """A saved catalog; another version, or another source than that it was made of, raises."""
    catalog = json.loads(open_bytes(path).read())
    if catalog.get("version") != 1:
        raise ValueError(f"unknown catalog version {catalog.get('version')!r}")
    if source is not None and catalog["source"] != identity(source):
        raise ValueError(f"the catalog was made of another version of {source}")
    return catalog


def logical_rows(lines: Iterator[tuple[int, bytes]], stop: int | None = None) -> Iterator[str]:
    """Logical rows up to the terminator, or up to offset stop; lines that go on are joined."""
    parts: list[bytes] = []
    for at, line in lines:
        if not parts and (ends_copy(line) or (stop is not None and at >= stop)):
            return
        if goes_on(line):
            parts.append(line)
            continue
        row = b"".join([*parts, line])
        parts.clear()
        row = row[:-2] if row.endswith(b"\r\n") else row[:-1] if row.endswith(b"\n") else row
        yield row.decode("utf-8")
    if parts:
        raise EOFError("the dump ends within a row")


class CopyRange(InputPartition):
    def __init__(self, offset: int, stop: int | None, skip_header: bool):
        self.offset, self.stop, self.skip_header = offset, stop, skip_header


class CopyReader(DataSourceReader):
    def __init__(self, options: dict):
        self.path, self.member = options["path"], options.get("member")
        catalog = load_catalog(options["catalog"]) if options.get("catalog") else build_catalog(self.path, self.member)
        self.tables = catalog["tables"]
        self.wanted = options.get("table")
        self.entry: dict | None = None
        with open_bytes(self.path) as f:
            self.direct = f.read(2) != b"\x1f\x8b"

    def partitions(self) -> list[InputPartition]:
        out = []
        for t in self.tables:
            if self.wanted in (None, t["table"], f"{t['schema']}.{t['table']}"):
                bounds = t["starts"] if self.direct else t["starts"][:1]
                for k, start in enumerate(bounds):
                    stop = bounds[k + 1] if k + 1 < len(bounds) else None
                    p = CopyRange(start + (t["tar_offset"] - t["sql_offset"] if self.direct else 0), stop and stop + t["tar_offset"] - t["sql_offset"], False)
                    p.table = t["table"]
                    out.append(p)
        return out or [CopyRange(-1, 0, False)]

    def read(self, partition: CopyRange) -> Iterator[pa.RecordBatch]:
        if partition.offset < 0:
            return
        if self.direct:
            stream = open_bytes(self.path)
        else:
            stream, _ = open_dump(self.path, self.member)
        with stream:
            stream.seek(partition.offset)
            base = partition.offset
            lines = ((base + at, line) for at, line in physical_lines(stream))
            rows = logical_rows(lines, partition.stop)
            while part := list(islice(rows, BATCH)):
                yield pa.RecordBatch.from_arrays([pa.array([partition.table] * len(part), pa.string()), pa.array(part, pa.string())], ["table", "line"])


class PruningCopyReader(CopyReader):
    """Also takes a filter on table as the table to read."""

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        for f in filters:
            if isinstance(f, EqualTo) and f.attribute == ("table",) and self.wanted in (None, f.value):
                self.wanted = f.value
            else:
                yield f


class CopySource(DataSource):
    """format("pgcopy"): rows (table, line) of a dump. Options path, table, catalog, member.

    Option pushdown=true, where spark.sql.python.filterPushdown.enabled is set, prunes by a filter on table.
    """

    @classmethod
    def name(cls) -> str:
        return "pgcopy"

    def schema(self) -> str:
        return "table string, line string"

    def reader(self, schema) -> CopyReader:
        options = dict(self.options)
        return (PruningCopyReader if options.get("pushdown") == "true" else CopyReader)(options)


def entry_of(catalog: dict[str, Any], table: str) -> dict[str, Any]:
    found = [t for t in catalog["tables"] if table in (t["table"], f"{t['schema']}.{t['table']}")]
    if not found:
        raise KeyError(f"the dump has no rows of table {table}")
    return found[0]


def declared(entry: dict[str, Any]) -> dict[str, str]:
    """Type of each column in COPY order; a geometry overrides, a column without DDL is unknown."""
    return {c: "geometry" if c in entry["geometries"] else entry["pg_types"].get(c, "unknown") for c in entry["columns"]}


def typed(lines: DataFrame, entry: dict[str, Any], fallback: bool = False, column: str = "line") -> DataFrame:
    """Typed columns of COPY lines. Types without a mapping raise when the plan is made, unless fallback."""
    spark = lines.sparkSession
    time_type = spark.conf.get("spark.sql.timeType.enabled", "false") == "true"
    types = declared(entry)
    fields = copytext.checked(copytext.split_fields(F.col(column)), len(types), f"{entry['schema']}.{entry['table']}")
    split = lines.select(fields.alias("f"))

    def value(k: int, pg_type: str) -> Column:
        return pgtypes.decode(copytext.unescape(F.col("f")[k]), pg_type, fallback, time_type)

    out = []
    for k, (name, pg_type) in enumerate(types.items()):
        meta: dict[str, Any] = {"pg_type": pg_type}
        if name in entry["geometries"]:
            meta |= entry["geometries"][name]
        out.append(value(k, pg_type).alias(name, metadata=meta))
    return split.select(*out)


def read_table(spark: SparkSession, path: str, table: str, catalog: str | None = None, fallback: bool = False, member: str | None = None) -> DataFrame:
    """A table of a dump, typed. Columns that a query doesn't select aren't decoded."""
    spark.dataSource.register(CopySource)
    entry = entry_of(load_catalog(catalog, path) if catalog else build_catalog(path, member, spark=spark), table)
    read = spark.read.format("pgcopy").option("path", path).option("table", table)
    for key, v in (("catalog", catalog), ("member", member)):
        if v:
            read = read.option(key, v)
    return typed(read.load(), entry, fallback)
