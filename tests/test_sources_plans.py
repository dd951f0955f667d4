import gzip
import io
import random
import json
import sqlite3
import struct
import tarfile
import zipfile
from pathlib import Path

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from lodestack.operators import layout, manifest
from lodestack.plans import commit, convert, migrate, moves, snapshots
from lodestack.sources import archives, catalogs, delimited, geo, jsonfiles, pgdump, plain, sheets
from lodestack.streaming import status

DUMP = r'''ALTER TABLE "s"."a" ADD COLUMN "x" integer NOT NULL;
ALTER TABLE "s"."a" ADD COLUMN "t" text;
SELECT AddGeometryColumn('s','a','g',2154,'POINT',2);
COPY "s"."a" ("x", "t", "g") FROM STDIN;
1	a\tb	01010000206a080000000000000000f03f0000000000000040
2	line\
two	\N
3	\N	\N
\.
ALTER TABLE "s"."b" ADD COLUMN "y" varchar(3);
COPY "s"."b" ("y") FROM STDIN;

abc
\.
ALTER TABLE "s"."c" ADD COLUMN "z" int8;
COPY "s"."c" ("z") FROM STDIN;
\.
'''  # fmt: skip


@pytest.fixture
def dump(tmp_path):
    p = tmp_path / "dump.sql"
    p.write_text(DUMP)
    return str(p)


def test_control_lines():
    assert pgdump.split_columns('"a", "b", "c"') == ["a", "b", "c"]
    assert pgdump.split_columns(' "a""b" , plain') == ['a"b', "plain"]
    assert pgdump.parse_control('ALTER TABLE "s"."t" ADD COLUMN "x" numeric(17, 3);') == ("column", ("s", "t", "x", "numeric(17, 3)"))
    kind, (schema, table, g) = pgdump.parse_control("SELECT AddGeometryColumn('s','adresse','geom_adresse',2154,'POINT',2);")
    assert (kind, schema, table, g.name, g.srid, g.geometry_type, g.dimensions) == ("geometry", "s", "adresse", "geom_adresse", 2154, "POINT", 2)
    assert pgdump.parse_control("-- a comment") is None


def test_catalog_of_two_tables():
    text = b'ALTER TABLE "s"."a" ADD COLUMN "x" INTEGER;\nCOPY "s"."a" ("x") FROM STDIN;\n1\n2\n\\.\nALTER TABLE "s"."b" ADD COLUMN "y" VARCHAR;\nCOPY "s"."b" ("y") FROM STDIN;\nhello\n\\.\n'
    tables = pgdump.scan(io.BytesIO(text), 4096)["tables"]
    assert [t["table"] for t in tables] == ["a", "b"] and [t["rows"] for t in tables] == [2, 1]
    for t in tables:
        part = text[t["sql_offset"] : t["sql_offset"] + t["range_size"]]
        assert part.startswith(b"COPY") and part.endswith(b"\\.\n") and t["tar_offset"] == 4096 + t["sql_offset"]
    with pytest.raises(EOFError):
        pgdump.scan(io.BytesIO(text[:-4]))


@pytest.mark.parametrize("form", ["sql", "crlf", "gz", "tar", "tar.gz"])
def test_read_dump(spark, dump, tmp_path, form):
    path = dump
    if form == "crlf":
        path = str(tmp_path / "crlf.sql")
        Path(path).write_bytes(DUMP.replace("\n", "\r\n").replace("line\\\r\n", "line\\\n").encode())
    elif form == "gz":
        path = dump + ".gz"
        with gzip.open(path, "wb") as f:
            f.write(DUMP.encode())
    elif form.startswith("tar"):
        path = str(tmp_path / f"d.{form}")
        with tarfile.open(path, "w:gz" if form.endswith("gz") else "w") as t:
            t.add(dump, "in/dump.sql")
    catalog = str(tmp_path / f"{form}.json")
    pgdump.save_catalog(pgdump.build_catalog(path, split=8), catalog)
    df = pgdump.read_table(spark, path, "a", catalog)
    rows = df.collect()
    assert [(r["x"], r["t"], r["g"] and bytes(r["g"]).hex()) for r in sorted(rows)] == [(1, "a\tb", "0101000000000000000000f03f0000000000000040"), (2, "line\ntwo", None), (3, None, None)]
    assert df.schema["g"].metadata["srid"] == 2154 and df.schema["x"].metadata["pg_type"] == "integer"
    assert [r["y"] for r in pgdump.read_table(spark, path, "s.b", catalog).collect()] == ["", "abc"]
    assert pgdump.read_table(spark, path, "c", catalog).count() == 0
    with pytest.raises(KeyError):
        pgdump.read_table(spark, path, "nope", catalog)
    assert Path(pgdump.unpack(path, str(tmp_path / "plain.sql"))).read_bytes() == (Path(path).read_bytes() if form in ("sql", "crlf") else DUMP.encode())


def walked(text):
    """Catalog facts line by line: (table, offset of COPY, end after the terminator, rows, offsets of rows)."""
    out, table, whole, at = [], None, True, 0
    for line in text.split(b"\n"):
        line += b"\n" if at + len(line) < len(text) else b""
        if table is None:
            found = pgdump.parse_control(line.decode())
            if found and found[0] == "copy":
                table, whole = (found[1][1], at, []), True
        elif whole and line.rstrip(b"\r\n") == b"\\.":
            out.append((table[0], table[1], at + len(line), len(table[2]), table[2]))
            table = None
        else:
            if whole:
                table[2].append(at)
            whole = not pgdump.goes_on(line)
        at += len(line)
    return out


def tricky_dump(seed, crlf):
    r = random.Random(seed)
    text = ""
    for t in range(4):
        text += f'-- c\nALTER TABLE "s"."t{t}" ADD COLUMN "x" text;\n\nCOPY "s"."t{t}" ("x") FROM STDIN;\n'
        for _ in range(r.randrange(0, 30)):
            text += r.choice(["plain", "", "two\\\nlines", "three\\\n\\\nlines", "slash\\\\", 'COPY "s"."no" ("x") FROM STDIN;', 'ALTER TABLE "s"."t0" ADD COLUMN "q" text;', "\\\\\\\n\\.", "x" * 50]) + "\n"
        text += "\\.\n"
    return (text.replace("\n", "\r\n").replace("\\\r\n", "\\\n") if crlf else text).encode()


@pytest.mark.parametrize("crlf", [False, True])
def test_scan_by_ranges(spark, tmp_path, monkeypatch, crlf):
    for seed in range(6):
        text = tricky_dump(seed, crlf)
        want = walked(text)
        assert len(want) == 4
        path = tmp_path / f"d{seed}.sql"
        path.write_bytes(text)
        for chunk in (1 << 20, 7):
            monkeypatch.setattr(pgdump, "CHUNK", chunk)
            for made in (pgdump.scan(io.BytesIO(text), split=20), *(pgdump.build_catalog(str(path), split=20, spark=spark, scanned=n) for n in ((40, 333) if chunk > 7 else ()))):
                assert [(t["table"], t["sql_offset"], t["sql_offset"] + t["range_size"], t["rows"]) for t in made["tables"]] == [w[:4] for w in want]
                for t, (*_, rows) in zip(made["tables"], want):
                    assert set(t["starts"]) <= set(rows) and t["starts"][:1] == rows[:1] and all(b - a >= 20 for a, b in zip(t["starts"], t["starts"][1:]))


def test_stale_catalog_raises(dump, tmp_path):
    pgdump.save_catalog(pgdump.build_catalog(dump), str(tmp_path / "c.json"))
    assert pgdump.load_catalog(str(tmp_path / "c.json"), dump)["tables"]
    Path(dump).write_text(DUMP + "\n")
    with pytest.raises(ValueError, match="another version"):
        pgdump.load_catalog(str(tmp_path / "c.json"), dump)


def test_convert(spark, dump, tmp_path):
    out = tmp_path / "out"
    assert [r["state"] for r in convert.convert(spark, dump, out, dry_run=True)] == ["listed"] * 3
    done = convert.convert(spark, dump, out)
    assert [(r["table"], r["rows"], r["state"]) for r in done] == [("a", 3, "done"), ("b", 2, "done"), ("c", 0, "done")]
    assert [r["state"] for r in convert.convert(spark, dump, out)] == ["skipped"] * 3
    files = sorted((out / "s" / "a").glob("*.parquet"))
    meta = pq.read_metadata(files[0]).metadata
    assert json.loads(meta[b"geo"])["primary_column"] == "g" and json.loads(meta[b"geo"])["columns"]["g"]["crs"]["id"]["code"] == 2154
    assert spark.read.parquet(str(out / "s" / "a")).count() == 3 and spark.read.parquet(str(out / "s" / "c")).columns == ["z"]
    assert [r["table"] for r in convert.table_manifest(spark, out).collect()] == ["a", "b", "c"]
    with pytest.raises(KeyError, match="nope"):
        convert.convert(spark, dump, out, tables=["a", "nope"])
    reference = tmp_path / "ref"
    reference.mkdir()
    (reference / "a.done.json").write_text(json.dumps({"table": "a", "rows": 4}))
    (reference / "b.done.json").write_text("broken")
    with pytest.raises(commit.CommitError, match="reference"):
        convert.convert(spark, dump, tmp_path / "out2", tables=["a"], reference=str(reference))


def test_commit_is_all_or_nothing(spark, tmp_path):
    df = spark.range(1000).coalesce(1)
    with pytest.raises(commit.CommitError, match="rows differ"):
        commit.commit(df, tmp_path / "t", {"path": "x"}, expected_rows=999)
    assert list(tmp_path.iterdir()) == []
    marker = commit.commit(df, tmp_path / "t", {"path": "x"}, 1000, part_rows=250)
    assert marker["parts"] == 4 and commit.is_complete(tmp_path / "t", {"path": "x"}) and not commit.is_complete(tmp_path / "t", {"path": "y"})
    with pytest.raises(commit.CommitError, match="exists"):
        commit.commit(df, tmp_path / "t", {"path": "x"})
    totals = commit.publish_tree(tmp_path / "t", tmp_path / "p")
    assert totals["rows"] == 1000 and totals["files"] == 4
    with pytest.raises(commit.CommitError):
        commit.publish_tree(tmp_path / "t", tmp_path / "p")
    (tmp_path / "deps" / "01").mkdir(parents=True)
    commit.commit(df, tmp_path / "deps" / "01" / "x", {"path": "x"})
    assert commit.publish_partitions(tmp_path / "deps", tmp_path / "q")["rows"] == 1000
    with pytest.raises(commit.CommitError):
        commit.free_space(tmp_path, floor=1 << 60)


def test_delimited(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes('﻿a;b\n1;"x\ny"\nNULL;\n"";null\n'.encode())
    assert delimited.dialect(str(tmp_path / "a.csv")) == (["a", "b"], ";")
    assert [tuple(r) for r in delimited.read_strings(spark, str(tmp_path / "a.csv")).collect()] == [("1", "x\ny"), (None, None), (None, None)]
    (tmp_path / "r.csv").write_bytes("a,b\n1\n1,2,é\n".encode("cp1252"))
    df, kind = delimited.read_any(spark, str(tmp_path / "r.csv"))
    assert kind == "lossless-csv-row-json" and [r[0] for r in df.collect()] == ['["a","b"]', '["1"]', '["1","2","é"]']
    (tmp_path / "h.csv").write_text("a,b\n")
    assert delimited.read_strings(spark, str(tmp_path / "h.csv")).count() == 0
    (tmp_path / "i.csv").write_text("a,b\n1,2.5\n3,4\n")
    assert delimited.read_inferred(spark, str(tmp_path / "i.csv")).dtypes == [("a", "int"), ("b", "double")]


def test_json_files(spark, tmp_path):
    def put(name, text):
        (tmp_path / name).write_text(text)
        return str(tmp_path / name)

    p = put("arr.json", '[1,{"b":2,"a":1},null,"q"]')
    assert jsonfiles.layout(p) == "array" and [r[0] for r in jsonfiles.read_array(spark, p).collect()] == ["1", '{"b":2,"a":1}', None, '"q"']
    p = put("cut.json", '[1,{"b":2.50,"a":1},{"q":')
    with pytest.raises(Exception, match="not a whole JSON array"):
        jsonfiles.read_array(spark, p).collect()
    rows = jsonfiles.salvage(spark, p).collect()
    assert [r["json"] for r in rows] == ["1", '{"b":2.5,"a":1}', None] and rows[-1]["error"]
    p = put("l.json", '{"a":1}\n\n{"b":2.50}\n')
    assert jsonfiles.layout(p) == "lines" and [r[0] for r in jsonfiles.read_lines(spark, p).collect()] == ['{"a":1}', '{"b":2.50}']
    p = put("o.json", '{"a":\n[1]}')
    assert jsonfiles.layout(p) == "object" and [tuple(r) for r in jsonfiles.read_object(spark, p).collect()] == [("a", "array-item", 0, "1")]
    p = put("g.geojson", '{"type":"FeatureCollection","features":[{"type":"Feature","properties":{"n":"x"},"geometry":{"type":"Point","coordinates":[1,2]}}]}')
    row = geo.read_geojson(spark, p).first()
    assert row["properties_json"] == '{"n":"x"}' and bytes(row["geometry"]).hex() == "0101000000000000000000f03f0000000000000040"


def test_plain_files(spark, tmp_path):
    (tmp_path / "t.txt").write_bytes(b"a\nb\r\nc")
    assert [tuple(r) for r in plain.read_lines(spark, str(tmp_path / "t.txt")).collect()] == [(1, "a\n"), (2, "b\r\n"), (3, "c")]
    assert [(r[0], bytes(r[1])) for r in plain.read_blob(spark, str(tmp_path / "t.txt")).collect()] == [("t.txt", b"a\nb\r\nc")]


def make_zip(path, members):
    with zipfile.ZipFile(path, "w") as z:
        for name, data in members.items():
            z.writestr(name, data)


def test_archives(spark, tmp_path):
    inner = io.BytesIO()
    make_zip(inner, {"in.txt": "deep"})
    make_zip(tmp_path / "z.zip", {"a.nt": "<a> <b> <c> .\n", "../evil": "x", "__MACOSX/a": "x", "d/._b": "x", "n.zip": inner.getvalue()})
    rows = {r["member"]: bytes(r["content"]) for r in archives.read_members(spark, str(tmp_path / "z.zip")).collect()}
    assert rows == {"a.nt": b"<a> <b> <c> .\n", "n.zip!in.txt": b"deep"}
    assert [r["value"] for r in archives.read_member_lines(spark, str(tmp_path / "z.zip"), ".nt").collect()] == ["<a> <b> <c> ."]
    (tmp_path / "bad.zip").write_bytes(b"PK\x03\x04broken")
    assert archives.archive_health(spark, str(tmp_path / "bad.zip")).first()["error"]
    import zstandard

    data = zstandard.ZstdCompressor().compress(b"zstd member")
    raw = io.BytesIO()
    make_zip(raw, {"m.txt": data})
    info = zipfile.ZipFile(raw).infolist()[0]
    info.compress_type, info.compress_size, info.file_size = 93, len(data), 11
    assert archives.member_bytes(raw.getvalue(), info) == b"zstd member"


def test_vector_files(spark, tmp_path):
    shp = bytearray(100)
    for x, y in ((1.0, 2.0), (3.0, 4.0)):
        body = struct.pack("<i2d", 1, x, y)
        shp += struct.pack(">2i", 1, len(body) // 2) + body
    dbf = struct.pack("<4xIHH20x", 2, 32 + 32 + 1, 6) + struct.pack("<11sc4xB15x", b"NAME", b"C", 5) + b"\r" + b" abc  " + b" \xe9    "
    (tmp_path / "p.shp").write_bytes(shp)
    (tmp_path / "p.dbf").write_bytes(dbf)
    rows = geo.read_shapefile(spark, str(tmp_path / "p.shp")).collect()
    assert [json.loads(r[0])["NAME"] for r in rows] == ["abc", "é"] and bytes(rows[0][1]) == geo.wkb({"type": "Point", "coordinates": [1, 2]})
    (tmp_path / "k.kml").write_text("<kml><Document><Placemark><name>n</name><Point><coordinates>1,2,0</coordinates></Point></Placemark></Document></kml>")
    assert [(json.loads(r[0]), bytes(r[1])) for r in geo.read_kml(spark, str(tmp_path / "k.kml")).collect()] == [({"name": "n"}, geo.wkb({"type": "Point", "coordinates": [1, 2]}))]
    db = sqlite3.connect(tmp_path / "g.gpkg")
    db.execute("create table gpkg_geometry_columns (table_name text, column_name text)")
    db.execute("insert into gpkg_geometry_columns values ('pts', 'geom')")
    db.execute("create table pts (id integer, geom blob)")
    db.execute("insert into pts values (7, ?)", (b"GP\0\x01" + struct.pack("<i", 4326) + geo.wkb({"type": "Point", "coordinates": [1, 2]}),))
    db.execute("create table other (v text)")
    db.execute("insert into other values ('q')")
    db.commit()
    db.close()
    rows = geo.read_geopackage(spark, str(tmp_path / "g.gpkg")).collect()
    assert [(r["layer"], r["properties_json"]) for r in rows] == [("other", '{"v":"q"}'), ("pts", '{"id":7}')] and bytes(rows[1]["geometry"]) == geo.wkb({"type": "Point", "coordinates": [1, 2]})
    assert geo.wkb({"type": "MultiPolygon", "coordinates": [[[[0, 0], [1, 0], [0, 0]]]]})[:9].hex() == "010600000001000000"


def test_sheets(tmp_path, spark):
    make_zip(tmp_path / "x.xlsx", {
        "xl/workbook.xml": '<workbook xmlns:r="r"><sheets><sheet name="S" r:id="i1"/></sheets></workbook>', "xl/_rels/workbook.xml.rels": '<Relationships><Relationship Id="i1" Target="worksheets/s.xml"/></Relationships>',
        "xl/sharedStrings.xml": "<sst><si><t>hello</t></si></sst>", "xl/worksheets/s.xml": '<worksheet><sheetData><row><c r="A1" t="s"><v>0</v></c><c r="C1"><v>2.5</v></c></row><row><c r="B2" t="b"><v>1</v></c></row></sheetData></worksheet>',
    })
    assert sheets.engine((tmp_path / "x.xlsx").read_bytes()) == "xlsx"
    assert [tuple(r)[1:] for r in sheets.read_sheets(spark, str(tmp_path / "x.xlsx")).collect()] == [("S", 1, '["hello",null,"2.5"]'), ("S", 2, '[null,"TRUE"]')]
    make_zip(tmp_path / "x.ods", {"content.xml": '<d xmlns:t="t"><t:table t:name="T"><t:table-row><t:table-cell><p>a</p></t:table-cell><t:table-cell t:number-columns-repeated="2"><p>b</p></t:table-cell></t:table-row></t:table></d>'})
    assert list(sheets.sheet_rows((tmp_path / "x.ods").read_bytes())) == [("T", ["a", "b", "b"])]
    book = '<?xml version="1.0"?><Workbook xmlns="urn:schemas-microsoft-com:office:spreadsheet" xmlns:ss="urn:schemas-microsoft-com:office:spreadsheet"><Worksheet ss:Name="S1"><Table><Row><Cell><Data>1</Data></Cell><Cell ss:Index="3"><Data>x</Data></Cell></Row></Table></Worksheet></Workbook>'
    assert list(sheets.sheet_rows(book.encode())) == [("S1", ["1", None, "x"])]
    assert list(sheets.sheet_rows(b"<table><tr><td>a<td>b &amp; c</tr></table>")) == [("table-0", ["a", "b & c"])]
    assert list(sheets.sheet_rows(b"a;b\n1;2\n")) == [("sheet", ["a", "b"]), ("sheet", ["1", "2"])]


def test_manifest_and_layout(spark, tmp_path):
    root = tmp_path / "root"
    for name, rows in (("transport/baac/a", 3), ("transport/baac/b", 4), ("transport/accidents/baac/b", 4), ("x/rna_import_20240105_z", 1)):
        spark.range(rows).coalesce(1).write.parquet(f"file://{tmp_path}/tmp/{name}")
        target = root / f"{name}.parquet"
        target.parent.mkdir(parents=True, exist_ok=True)
        next((tmp_path / "tmp" / name).glob("*.parquet")).rename(target)
    m = manifest.build(spark, str(root), checksum=True)
    rows = {r["path"]: r for r in m.collect()}
    assert rows["transport/baac/b.parquet"]["rows"] == 4 and len(rows["x/rna_import_20240105_z.parquet"]["sha256"]) == 64
    again = manifest.build(spark, str(root), True, m)
    assert [tuple(r) for r in again.collect()] == [tuple(r) for r in m.collect()]
    assert manifest.totals(m).first()["files"] == 4 and manifest.totals(m).first()["schemas"] == 1
    files = moves.relative_files(spark, str(root))
    assert [r["destination"] for r in layout.by_dated_name(files).collect()] == ["import/2024-01-05/rna_import_20240105_z.parquet"]
    plan = layout.by_prefix(files)
    planned = layout.actions(plan, moves.state(spark, str(root), plan))
    assert {r["source"]: r["action"] for r in planned.collect()} == {"transport/baac/a.parquet": "move", "transport/baac/b.parquet": "drop-source-duplicate"}
    planned = spark.createDataFrame(planned.collect(), planned.schema)
    assert moves.apply(spark, str(root), planned) == {"move": 1, "drop-source-duplicate": 1}
    assert not (root / "transport/baac").exists() and (root / "transport/accidents/baac/a.parquet").exists()
    with pytest.raises(moves.Conflict):
        moves.apply(spark, str(root), planned.withColumn("action", F.lit("conflict-size")))


def test_migrate_and_retry(spark, tmp_path):
    raw = tmp_path / "raw"
    raw.mkdir()
    (raw / "a.csv").write_text("x,y\n1,2\n")
    (raw / "b.json").write_text('[1,{"a":2}]')
    (raw / "c.json").write_text('[1,2,{"a"')
    (raw / "d.pdf").write_text("no")
    (raw / "e.rar").write_bytes(b"Rar!\x1a\x07\x00")
    (raw / "h.geojson").write_text('{"type":"FeatureCollection","features":[{"type":"Feature","properties":{"n":1},"geometry":{"type":"Odd","coordinates":[]}}]}')
    make_zip(raw / "f.zip", {"in/g.csv": "q\n5\n", "note.pdf": "x"})
    log = tmp_path / "log.jsonl"
    counts = migrate.run(spark, str(raw), tmp_path / "out", log)
    assert counts == {"done": 4, "partial": 1, "unsupported": 1}
    assert spark.read.parquet(str(tmp_path / "out" / "b.json.parquet")).count() == 2
    part = json.loads((tmp_path / "out" / "c.json.partial.json").read_text())
    assert part["status"] == "partial" and part["rows_recovered"] == 2
    assert spark.read.parquet(str(tmp_path / "out" / "f.zip.parquet" / "in" / "g.csv.parquet")).collect()[0][0] == "5"
    assert migrate.run(spark, str(raw), tmp_path / "out", log)["skip"] == 4
    from lodestack.operators import reconcile

    records = catalogs.read_logs(spark, str(log))
    sizes = spark.createDataFrame([(str(p), p.stat().st_size) for p in raw.iterdir()], "source string, bytes long")
    states = {r["raw_path"]: r["class"] for r in reconcile.classify(records, str(raw), sizes).collect()}
    assert states == {"a.csv": "complete", "b.json": "complete", "c.json": "partial", "e.rar": "ignored", "f.zip": "complete", "h.geojson": "complete"} or states["c.json"] in ("partial", "missing")
    queue = reconcile.retry_queue(records, str(raw), ["ignored"], sizes).collect()
    assert [r["source"] for r in queue] == [str(raw / "e.rar")]


def test_small_files_migrate_together(spark, tmp_path, monkeypatch):
    """Many small files take a few jobs, not some each; outputs and log are those of files that are migrated alone."""
    import gzip

    raw = tmp_path / "raw"
    (raw / "é %41 b").mkdir(parents=True)
    texts = {f"p{i}.csv": f"x,y\n{i},b\n" for i in range(40)} | {f"q{i}.json": f'[{i}, {{"a": 1.50}}, null]' for i in range(40)} | {f"r{i}.json": "[" for i in range(6)}
    texts |= {
        "é %41 b/a.csv": 'x,y\n"1\n2",null\nNULL,"a ""b"""\n', "head.csv": "x,y\n", "ragged.csv": "x,y\n1\n", "long.csv": "x,y\n1,2,3\n", "blank.csv": "x,y\n\n 1 ,\n\n", "bom.csv": "\ufeffx,y\r\n1,2\r\n", "odd.csv": "x,X\n1,2\n", "[z].csv": "x,y\n7,8\n",
        "none.json": "[]", "cut.json": '[1, {"a": 2}, [', "nested.json": ' [ [1, 2] , "t\\u00e9" ]\n', "tail.json": "[1] x", "lines.json": '{"a": 1}\n{"a": 2}\n', "t1.tsv": "x\ty\n1\t2\n", "t2.tsv": "x\ty\n3\t\n",
    }
    for name, text in texts.items():
        (raw / name).write_text(text)
    for i in range(3):
        (raw / f"g{i}.csv.gz").write_bytes(gzip.compress(b"x,y\n5,6\n"))
        (raw / f"g{i}.json.gz").write_bytes(gzip.compress(b"[1, 2]" if i else b"[1, 2"))

    def state(out, log):
        records = {r["source"].split("raw/")[1]: (r["status"], r["rows"], r["kind"], r["output"].removeprefix(str(out))) for r in catalogs.read_logs(spark, str(log)).collect()}
        tables = {}
        for marker in out.rglob("_SUCCESS.json"):
            df = spark.read.parquet(str(marker.parent))
            told = json.loads(marker.read_text())
            tables[str(marker.parent.relative_to(out))] = (df.dtypes, sorted(map(str, df.collect())), told["rows"], told["parts"], told["source"], told.get("representation"))
        return records, tables, sorted(str(p.relative_to(out)) for p in out.rglob("*.partial.json"))

    single = []
    migrated = migrate.migrate_file
    monkeypatch.setattr(migrate, "migrate_file", lambda *a, **b: single.append(a[1]) or migrated(*a, **b))
    together = migrate.run(spark, str(raw), tmp_path / "a", tmp_path / "a.jsonl")
    assert len(single) < 16
    got = state(tmp_path / "a", tmp_path / "a.jsonl")
    monkeypatch.setattr(migrate, "SMALL", -1)
    assert migrate.run(spark, str(raw), tmp_path / "b", tmp_path / "b.jsonl") == together
    for x, y in zip(got, state(tmp_path / "b", tmp_path / "b.jsonl")):
        assert x == y
    assert len(got[0]) == len(texts) + 6 and not list((tmp_path / "a").rglob("*.staging"))


def test_a_failing_job_is_halved(spark, tmp_path, monkeypatch):
    raw = tmp_path / "raw"
    raw.mkdir()
    for i in range(20):
        (raw / f"{i}.csv").write_text("x,y\n1,2\n")
    together = migrate.delimited.read_strings_of

    def read(spark, paths, header, delimiter):
        if any(p.endswith("/13.csv") for p in paths):
            raise RuntimeError("unreadable")
        return together(spark, paths, header, delimiter)

    monkeypatch.setattr(migrate.delimited, "read_strings_of", read)
    assert migrate.run(spark, str(raw), tmp_path / "out", tmp_path / "log.jsonl") == {"done": 20}
    assert spark.read.parquet(*map(str, (tmp_path / "out").iterdir())).count() == 20


def test_migrate_layers_and_sheets(spark, tmp_path):
    """One dataset a layer with typed attributes, one a sheet of strings; a Parquet file byte for byte."""
    raw = tmp_path / "raw"
    raw.mkdir()
    db = sqlite3.connect(raw / "g.gpkg")
    db.execute("create table roads (id integer, name text, length real)")
    db.executemany("insert into roads values (?, ?, ?)", [(1, "a", 1.5), (2, None, 2.0)])
    db.execute("create table places (v text)")
    db.execute("insert into places values ('q')")
    db.commit()
    db.close()
    make_zip(raw / "x.xlsx", {
        "xl/workbook.xml": '<workbook xmlns:r="r"><sheets><sheet name="One" r:id="i1"/></sheets></workbook>', "xl/_rels/workbook.xml.rels": '<Relationships><Relationship Id="i1" Target="worksheets/s.xml"/></Relationships>',
        "xl/worksheets/s.xml": '<worksheet><sheetData><row><c r="A1" t="inlineStr"><is><t>k</t></is></c><c r="C1" t="inlineStr"><is><t>K</t></is></c></row><row><c r="A2"><v>7</v></c><c r="C2"><v>2.5</v></c></row></sheetData></worksheet>',
    })
    (raw / "p.geojson").write_text('{"type":"FeatureCollection","features":[{"type":"Feature","properties":{"n":1,"s":"x"},"geometry":null},{"type":"Feature","properties":{"n":2.5},"geometry":null}]}')
    spark.range(10).coalesce(1).write.parquet(str(tmp_path / "q"))
    one = next((tmp_path / "q").glob("part-*.parquet"))
    (raw / "q.parquet").write_bytes(one.read_bytes())
    out = tmp_path / "out"
    assert migrate.run(spark, str(raw), out, tmp_path / "log.jsonl") == {"done": 4}
    roads = spark.read.parquet(str(out / "g.gpkg.parquet" / "roads.parquet"))
    assert sorted((r["id"], r["name"], float(r["length"])) for r in roads.collect()) == [(1, "a", 1.5), (2, None, 2.0)] and dict(roads.dtypes)["id"] == "bigint"
    assert spark.read.parquet(str(out / "g.gpkg.parquet" / "places.parquet")).first()["v"] == "q"
    assert [r.asDict() for r in spark.read.parquet(str(out / "x.xlsx.parquet" / "one.parquet")).collect()] == [{"k": "7", "column.2": None, "K.3": "2.5"}]
    assert sorted((float(r["n"]), r["s"], r["geometry"]) for r in spark.read.parquet(str(out / "p.geojson.parquet")).collect()) == [(1.0, "x", None), (2.5, None, None)]
    assert next((out / "q.parquet.parquet").glob("*.parquet")).read_bytes() == one.read_bytes()
    assert migrate.run(spark, str(raw), out, tmp_path / "log.jsonl") == {"skip": 4}


def test_logs_in_order(spark, tmp_path):
    def put(name, *records):
        (tmp_path / name).write_text("\n".join(json.dumps(r) for r in records) + "\n\n")
        return str(tmp_path / name)

    paths = [put("l-pass10.jsonl", {"source": "/r/a", "status": "done"}), put("l.jsonl", {"source": "/r/a", "status": "failed", "error": "e"}, {"source": "/r/b", "status": "failed"}, {"source": "/r/b", "status": "done"}), put("l-pass2.jsonl", {"source": "/r/a", "status": "partial"}, {"source": "/r/z!m", "status": "failed"})]
    from lodestack.operators import reconcile

    assert {r["raw_path"]: r["class"] for r in reconcile.classify(catalogs.read_logs(spark, *paths), "/r").collect()} == {"a": "complete", "b": "complete"}
    (tmp_path / "bad.jsonl").write_text('{"source": \n')
    with pytest.raises(Exception, match="invalid JSON"):
        catalogs.read_logs(spark, str(tmp_path / "bad.jsonl")).collect()


def test_tsv(spark, tmp_path):
    df = spark.createDataFrame([("a\tb", 3, "f" * 64, True), ("c", 4, "e" * 64, False)], "path string, bytes long, sha256 string, partial boolean")
    catalogs.write_tsv(df.withColumn("partial", F.col("partial").cast("int")), str(tmp_path / "m.tsv"))
    assert [tuple(r) for r in catalogs.read_manifest(spark, str(tmp_path / "m.tsv")).collect()] == [tuple(r) for r in df.collect()]
    with pytest.raises(ValueError, match="sha256"):
        catalogs.write_tsv(df.select("path"), str(tmp_path / "n.tsv"))
        catalogs.read_manifest(spark, str(tmp_path / "n.tsv"))


def test_snapshots(spark, tmp_path):
    make_zip(tmp_path / "Flux 1.nt.zip", {"x.nt": '<a> <b> "c" .\n\n_:x <p> <o> .\n'})
    got = snapshots.convert_triples(spark, str(tmp_path / "Flux 1.nt.zip"), tmp_path / "out")
    assert got["name"] == "flux-1" and got["rows"] == 2
    assert snapshots.convert_triples(spark, str(tmp_path / "Flux 1.nt.zip"), tmp_path / "out")["state"] == "skipped"
    make_zip(tmp_path / "z.zip", {"a.geojson": '{"type":"FeatureCollection","features":[{"type":"Feature","properties":{},"geometry":null}]}', "b.txt": "x"})
    done = snapshots.convert_features(spark, str(tmp_path / "z.zip"), tmp_path / "out", tmp_path / "work")
    assert [r["name"] for r in done] == ["a-geojson"]
    (tmp_path / "Arrêtés 1.csv").write_text("a,b\n1,2\n")
    assert snapshots.convert_orders(spark, tmp_path, tmp_path / "out")[0]["rows"] == 1
    assert snapshots.write_manifest([got, *done], tmp_path / "out")["rows"] == 3


def test_streams(spark, tmp_path):
    schema = "source string, status string, at long"
    base = f"file://{tmp_path}"
    put = lambda *rows: spark.createDataFrame(rows, schema).write.mode("append").parquet(f"{base}/in")
    put(("a", "failed", 1), ("b", "done", 2))
    for more in ((), (("a", "done", 3), ("c", "failed", 4))):
        if more:
            put(*more)
        stream = spark.readStream.schema(schema).parquet(f"{base}/in")
        status.run_latest(stream, "source", ["at"], ["status"], f"{base}/out", f"{base}/state").awaitTermination()
    assert {r["source"]: r["status"] for r in status.read_latest(spark, f"{base}/out", "source").collect()} == {"a": "done", "b": "done", "c": "failed"}
    status.new_files(spark, f"{base}/in", f"{base}/seen", f"{base}/seen-state").awaitTermination()
    n = spark.read.parquet(f"{base}/seen").count()
    put(("d", "done", 5))
    status.new_files(spark, f"{base}/in", f"{base}/seen", f"{base}/seen-state").awaitTermination()
    assert spark.read.parquet(f"{base}/seen").count() > n


def test_ods_gaps_keep_columns(tmp_path):
    empty = '<t:table-cell t:number-columns-repeated="{}"/>'
    cell = "<t:table-cell><p>{}</p></t:table-cell>"
    make_zip(tmp_path / "x.ods", {"content.xml": f'<d xmlns:t="t"><t:table t:name="T"><t:table-row>{cell.format("A")}{empty.format(2)}{empty.format(1)}{cell.format("E")}{empty.format(16379)}</t:table-row></t:table></d>'})
    assert list(sheets.sheet_rows((tmp_path / "x.ods").read_bytes())) == [("T", ["A", None, None, None, "E"])]
