"""Vector files: GeoJSON, shapefile, KML and GeoPackage to attributes and WKB."""

from __future__ import annotations

import json
import re
import sqlite3
import struct
import tempfile
import xml.etree.ElementTree as ET
from collections.abc import Iterator
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestack.sources import jsonfiles

# Geometry types of WKB, and of shapes.
WKB = {"Point": 1, "LineString": 2, "Polygon": 3, "MultiPoint": 4, "MultiLineString": 5, "MultiPolygon": 6, "GeometryCollection": 7}
POINT, POLYLINE, POLYGON, MULTIPOINT = 1, 3, 5, 8


def wkb(geometry: dict[str, Any] | None) -> bytes | None:
    """Little-endian 2D WKB of a GeoJSON geometry; third ordinates are left out."""
    if geometry is None:
        return None
    kind = geometry["type"]
    head = struct.pack("<BI", 1, WKB[kind])
    if kind == "GeometryCollection":
        parts = [wkb(g) or b"" for g in geometry["geometries"]]
        return head + struct.pack("<I", len(parts)) + b"".join(parts)
    c = geometry["coordinates"]

    def points(line: list) -> bytes:
        return struct.pack("<I", len(line)) + b"".join(struct.pack("<2d", p[0], p[1]) for p in line)

    if kind == "Point":
        return head + (struct.pack("<2d", c[0], c[1]) if c else struct.pack("<2d", float("nan"), float("nan")))
    if kind == "LineString":
        return head + points(c)
    if kind == "Polygon":
        return head + struct.pack("<I", len(c)) + b"".join(map(points, c))
    inner = kind[5:]
    return head + struct.pack("<I", len(c)) + b"".join(wkb({"type": inner, "coordinates": x}) or b"" for x in c)


def read_geojson(spark: SparkSession, path: str) -> DataFrame:
    """properties_json, geometry (WKB) of each feature."""
    features = jsonfiles.read_features(spark, path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = [json.loads(x) for x in batch.column(0).to_pylist()]
            properties = [json.dumps(v.get("properties") or {}, ensure_ascii=False, separators=(",", ":")) for v in values]
            yield pa.RecordBatch.from_arrays([pa.array(properties, pa.string()), pa.array([wkb(v.get("geometry")) for v in values], pa.binary())], ["properties_json", "geometry"])

    return features.mapInArrow(run, "properties_json string, geometry binary")


def _dbf(data: bytes, encoding: str = "cp1252") -> Iterator[dict[str, str | None]]:
    """Records of a dBase table, attributes as text."""
    n, start, size = struct.unpack_from("<IHH", data, 4)
    fields = []
    for at in range(32, start - 1, 32):
        if data[at] == 0x0D:
            break
        fields.append((data[at : at + 11].split(b"\0")[0].decode("ascii", "replace"), data[at + 16]))
    for k in range(n):
        row, at, out = data[start + k * size : start + (k + 1) * size], 1, {}
        for name, width in fields:
            text = row[at : at + width].decode(encoding, "replace").strip("\0 ")
            out[name], at = text or None, at + width
        yield out


def _ring_area(ring: list) -> float:
    return sum(a[0] * b[1] - b[0] * a[1] for a, b in zip(ring, ring[1:])) / 2


def _shape(data: bytes) -> dict[str, Any] | None:
    kind = struct.unpack_from("<i", data)[0]
    if kind == 0:
        return None
    flat = kind % 10
    if flat == POINT:
        return {"type": "Point", "coordinates": list(struct.unpack_from("<2d", data, 4))}
    if flat == MULTIPOINT:
        n = struct.unpack_from("<i", data, 36)[0]
        return {"type": "MultiPoint", "coordinates": [list(struct.unpack_from("<2d", data, 40 + 16 * k)) for k in range(n)]}
    parts, n = struct.unpack_from("<2i", data, 36)
    cuts = [*struct.unpack_from(f"<{parts}i", data, 44), n]
    at = 44 + 4 * parts
    line = [list(struct.unpack_from("<2d", data, at + 16 * k)) for k in range(n)]
    rings = [line[a:b] for a, b in zip(cuts, cuts[1:])]
    if flat == POLYLINE:
        return {"type": "LineString", "coordinates": rings[0]} if parts == 1 else {"type": "MultiLineString", "coordinates": rings}
    if flat != POLYGON:
        raise ValueError(f"unsupported shape type {kind}")
    polygons: list[list] = []
    for ring in rings:  # outer rings run clockwise; holes follow theirs
        if _ring_area(ring) <= 0 or not polygons:
            polygons.append([ring])
        else:
            polygons[-1].append(ring)
    return {"type": "Polygon", "coordinates": polygons[0]} if len(polygons) == 1 else {"type": "MultiPolygon", "coordinates": polygons}


def shapes(shp: bytes, dbf: bytes | None, encoding: str = "cp1252") -> Iterator[tuple[str, bytes | None]]:
    """(attributes as JSON, WKB) of a shapefile's records. The index file isn't needed."""
    rows = _dbf(dbf, encoding) if dbf else iter(())
    at = 100
    while at + 8 <= len(shp):
        size = struct.unpack_from(">i", shp, at + 4)[0] * 2
        yield json.dumps(next(rows, {}), ensure_ascii=False, separators=(",", ":")), wkb(_shape(shp[at + 8 : at + 8 + size]))
        at += 8 + size


def read_shapefile(spark: SparkSession, path: str, encoding: str = "cp1252") -> DataFrame:
    """properties_json, geometry of .shp files and the .dbf beside each; a task reads a pair."""
    folder = path.rsplit("/", 1)[0] if path.lower().endswith(".shp") else path
    name = path.rsplit("/", 1)[1][:-4] if path.lower().endswith(".shp") else "*"
    files = spark.read.format("binaryFile").option("pathGlobFilter", f"{name}.{{shp,SHP,dbf,DBF}}").load(folder)
    stem = F.regexp_replace("path", r"\.[^.]*$", "")
    pairs = files.groupBy(stem.alias("stem")).agg(F.max(F.when(F.lower("path").endswith(".shp"), F.col("content"))).alias("shp"), F.max(F.when(F.lower("path").endswith(".dbf"), F.col("content"))).alias("dbf"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shp, dbf in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                rows = list(shapes(shp, dbf, encoding))
                yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.binary())], ["properties_json", "geometry"])

    return pairs.filter("shp is not null").select("shp", "dbf").mapInArrow(run, "properties_json string, geometry binary")


def placemarks(data: bytes) -> Iterator[tuple[str, bytes | None]]:
    """(name, description and data as JSON, WKB) of KML placemarks."""
    def tag(e: ET.Element) -> str:
        return e.tag.rsplit("}", 1)[-1]

    def line(text: str | None) -> list:
        return [[float(v) for v in p.split(",")[:2]] for p in (text or "").split()]

    def geometry(e: ET.Element) -> dict | None:
        kind = tag(e)
        text = {tag(x): x.text for x in e.iter()}.get("coordinates")
        if kind == "Point":
            return {"type": "Point", "coordinates": (line(text) or [[]])[0]}
        if kind in ("LineString", "LinearRing"):
            return {"type": "LineString", "coordinates": line(text)}
        if kind == "Polygon":
            return {"type": "Polygon", "coordinates": [line(x.text) for x in e.iter() if tag(x) == "coordinates"]}
        if kind == "MultiGeometry":
            return {"type": "GeometryCollection", "geometries": [g for x in e if (g := geometry(x))]}
        return None

    for mark in ET.fromstring(data).iter():
        if tag(mark) != "Placemark":
            continue
        values: dict[str, str | None] = {tag(x): x.text for x in mark if tag(x) in ("name", "description")}
        for x in mark.iter():
            if tag(x) == "SimpleData":
                values[x.get("name", "")] = x.text
            elif tag(x) == "Data":
                values[x.get("name", "")] = next((v.text for v in x if tag(v) == "value"), None)
        shape = next((g for x in mark if (g := geometry(x))), None)
        yield json.dumps(values, ensure_ascii=False, separators=(",", ":")), wkb(shape)


def read_kml(spark: SparkSession, path: str) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for data in batch.column(0).to_pylist():
                rows = list(placemarks(data))
                yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.binary())], ["properties_json", "geometry"])

    return spark.read.format("binaryFile").load(path).select("content").mapInArrow(run, "properties_json string, geometry binary")


def layers(data: bytes) -> Iterator[tuple[str, str, bytes | None]]:
    """(layer, row as JSON, WKB) of all tables of a SQLite or GeoPackage file."""
    with tempfile.NamedTemporaryFile(suffix=".sqlite") as f:
        f.write(data)
        f.flush()
        db = sqlite3.connect(f"file:{f.name}?mode=ro&immutable=1", uri=True)
        tables = [r[0] for r in db.execute("select name from sqlite_master where type = 'table' and name not like 'sqlite_%' and name not like 'gpkg_%' and name not like 'rtree_%' order by name")]
        shape = dict(db.execute("select table_name, column_name from gpkg_geometry_columns")) if db.execute("select 1 from sqlite_master where name = 'gpkg_geometry_columns'").fetchone() else {}
        for t in tables:
            rows = db.execute('select * from "' + t.replace('"', '""') + '"')
            names = [d[0] for d in rows.description]
            for r in rows:
                row = dict(zip(names, r))
                g = row.pop(shape.get(t, ""), None)
                if g is not None:  # GeoPackage header: magic, version, flags, srid, envelope
                    g = g[8 + (0, 32, 48, 48, 64)[g[3] >> 1 & 7] :]
                yield t, json.dumps({k: v.hex() if isinstance(v, bytes) else v for k, v in row.items()}, ensure_ascii=False, separators=(",", ":")), g
        db.close()


def read_geopackage(spark: SparkSession, path: str) -> DataFrame:
    """layer, properties_json, geometry of every layer; files are read in parallel."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for data in batch.column(0).to_pylist():
                rows = list(layers(data))
                yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate((pa.string(), pa.string(), pa.binary()))], ["layer", "properties_json", "geometry"])

    return spark.read.format("binaryFile").load(path).select("content").mapInArrow(run, "layer string, properties_json string, geometry binary")


def attributes(rows: DataFrame) -> DataFrame:
    """rows with a column for each member of properties_json, typed by all values, in place of it.

    Members whose names differ by case alone, or that are called as another column, stay in
    properties_json, together with all others; so does everything if there are no members.
    """
    found = rows.agg(F.schema_of_variant_agg(F.try_parse_json("properties_json"))).first()[0]
    if not (found or "").startswith("OBJECT<"):
        return rows
    schema = re.sub(r"\bVOID\b", "STRING", re.sub(r"\bOBJECT<", "STRUCT<", found))
    typed = rows.withColumn("_p", F.from_json("properties_json", schema))
    names = typed.schema["_p"].dataType.names
    others = [c for c in rows.columns if c != "properties_json"]
    if not names or len({n.lower() for n in (*names, *others)}) < len(names) + len(others):
        return rows
    quoted = ["`" + n.replace("`", "``") + "`" for n in names]
    return typed.select(*[F.col(f"_p.{q}").alias(n) for q, n in zip(quoted, names)], *others)


#: Coordinate reference systems that need no other library (fixed values of the EPSG registry).
CRS = {4326: ("WGS 84", "degree"), 2154: ("RGF93 v1 / Lambert-93", "metre"), 3857: ("WGS 84 / Pseudo-Mercator", "metre")}


def geo_metadata(geometries: list[dict[str, Any]]) -> dict[str, Any]:
    """GeoParquet 1.1 metadata of geometry columns in order, the first being primary.

    Systems outside CRS are named by their code alone.
    """
    from lodestack.functions.ewkb import canonical_type

    columns = {}
    for g in geometries:
        srid = g.get("srid")
        kind = canonical_type(g["geometry_type"]) + (" Z" if g.get("dimensions") == 3 else "")
        crs = {"id": {"authority": "EPSG", "code": srid}, "name": CRS.get(srid, (f"EPSG:{srid}",))[0]} if srid else None
        columns[g["name"]] = {"encoding": "WKB", "geometry_types": [kind], "crs": crs}
    return {"version": "1.1.0", "primary_column": geometries[0]["name"], "columns": columns}
