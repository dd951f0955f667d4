"""Conversion of a dump to typed Parquet tables, one commit each, skipping tables that are done."""

from __future__ import annotations

import io
import json
from collections.abc import Iterable
from pathlib import Path
from typing import Any

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession

from lodestack.plans import commit
from lodestack.sources import geo, pgdump
from lodestack.sources.files import atomic_json, identity, write_atomically


def load_reference(folder: str | Path) -> dict[str, dict[str, Any]]:
    """Row counts and columns of an earlier conversion (`*.done.json`), by table; broken files are passed over."""
    out = {}
    for f in sorted(Path(folder).rglob("*.done.json")):
        try:
            data = json.loads(f.read_text(encoding="utf-8"))
            out[str(data["table"])] = data
        except (OSError, ValueError, KeyError, TypeError):
            continue
    return out


def wanted(catalog: dict[str, Any], tables: Iterable[str] | None) -> list[dict[str, Any]]:
    """Entries to convert; requested tables that the dump hasn't raise together."""
    if tables is None:
        return catalog["tables"]
    asked = set(tables)
    out = [t for t in catalog["tables"] if asked & {t["table"], f"{t['schema']}.{t['table']}"}]
    known = {n for t in out for n in (t["table"], f"{t['schema']}.{t['table']}")}
    if missing := sorted(asked - known):
        raise KeyError(f"the dump has no tables {', '.join(missing)}")
    return out


def convert(spark: SparkSession, source: str, output: str | Path, catalog_path: str | None = None, tables: Iterable[str] | None = None, fallback: bool = False, reference: str | None = None, dry_run: bool = False, member: str | None = None) -> list[dict[str, Any]]:
    """Convert the tables of a dump; returns a record each: table, rows, parts, state (done, skipped, listed).

    Types are checked for all tables before anything is written. A table whose marker names this
    very source is skipped; a folder without such a marker raises. Counts must equal the catalog's, and the reference's if given.
    """
    output, source_id = Path(output), identity(source)
    catalog_path = catalog_path or str(output / "catalog.json")
    try:
        catalog = pgdump.load_catalog(catalog_path, source)
    except (OSError, ValueError):
        catalog = pgdump.build_catalog(source, member, spark=spark)
        pgdump.save_catalog(catalog, catalog_path)
    entries = wanted(catalog, tables)
    earlier = load_reference(reference) if reference else {}
    if dry_run:
        return [{"table": t["table"], "rows": t["rows"], "columns": t["columns"], "state": "listed"} for t in entries]
    frames = {t["table"]: pgdump.read_table(spark, source, t["table"], catalog_path, fallback, member) for t in entries}
    out = []
    for t in entries:
        target = output / t["schema"] / t["table"]
        if commit.is_complete(target, source_id):
            out.append({"table": t["table"], "rows": commit.read_marker(target)["rows"], "state": "skipped"})
            continue
        if old := earlier.get(t["table"]):
            if old.get("rows", t["rows"]) != t["rows"] or list(old.get("columns", t["columns"])) != t["columns"]:
                raise commit.CommitError(f"{t['table']} differs from the reference")
        metadata: dict[str, Any] = {"lodestack.pg_types": pgdump.declared(t)}
        shapes = [t["geometries"][c] for c in t["columns"] if c in t["geometries"]]
        if shapes:
            metadata["geo"] = geo.geo_metadata(shapes)
        marker = commit.commit(frames[t["table"]], target, source_id, t["rows"], metadata=metadata, extra={"table": t["table"], "columns": t["columns"], "geometry_columns": [g["name"] for g in shapes]})
        out.append({"table": t["table"], "rows": marker["rows"], "parts": marker["parts"], "state": "done"})
    if manifest := table_manifest(spark, output):
        rows = [r.asDict() for r in manifest.collect()]
        atomic_json(output / "manifest.json", rows)
        buffer = io.BytesIO()
        pq.write_table(pa.Table.from_pylist(rows), buffer, compression="zstd")
        write_atomically(output / "manifest.parquet", buffer.getvalue())
    return out


def table_manifest(spark: SparkSession, output: str | Path) -> DataFrame | None:
    """table, rows, parts, parquet_bytes, columns, geometry_columns, completed_at of all commits below output; None if there are none."""
    markers = [json.loads(p.read_text()) for p in sorted(Path(output).rglob(commit.MARKER))]
    rows = [(m["table"], m["rows"], m["parts"], m["parquet_bytes"], len(m["columns"]), json.dumps(m["geometry_columns"]), m["completed_at"]) for m in markers if "table" in m]
    schema = "table string, rows long, parts long, parquet_bytes long, columns int, geometry_columns string, completed_at string"
    return spark.createDataFrame(rows, schema).orderBy("table") if rows else None
