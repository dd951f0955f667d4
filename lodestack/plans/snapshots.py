"""Conversion of snapshot sets: N-Triples zips, CSV folders, GeoJSON zips."""

from __future__ import annotations

import re
from pathlib import Path
from typing import Any

from pyspark.sql import SparkSession

from lodestack.functions import ntriples
from lodestack.plans import commit
from lodestack.sources import archives, delimited, geo
from lodestack.sources.files import atomic_json, identity, utc_now

TRIPLE_ROWS = 500_000


def slug(text: str) -> str:
    return re.sub(r"[^a-z0-9]+", "-", text.lower()).strip("-") or "dataset"


def snapshot_name(path: str | Path) -> str:
    return slug(re.sub(r"\.nt\.zip$", "", Path(path).name, flags=re.I))


def _commit(df, target: Path, source: str, extra: dict[str, Any], part_rows: int = commit.PART_ROWS) -> dict[str, Any]:
    who = identity(source)
    if commit.is_complete(target, who):
        return {**commit.read_marker(target), "name": target.name, "state": "skipped"}
    return {**commit.commit(df, target, who, part_rows=part_rows, extra=extra), "name": target.name, "state": "done"}


def convert_triples(spark: SparkSession, source: str, output: str | Path) -> dict[str, Any]:
    """A zip with one `.nt` member to subject, predicate, object, object_kind."""
    lines = archives.read_member_lines(spark, source, ".nt")
    return _commit(ntriples.triples(lines), Path(output, snapshot_name(source)), source, {"kind": "ntriples"}, TRIPLE_ROWS)


def convert_strings(spark: SparkSession, source: str, output: str | Path) -> dict[str, Any]:
    """A comma-separated UTF-8 file to strings."""
    return _commit(delimited.read_strings(spark, source, ","), Path(output, slug(Path(source).stem)), source, {"kind": "csv"})


def convert_features(spark: SparkSession, source: str, output: str | Path, work: str | Path) -> list[dict[str, Any]]:
    """GeoJSON members of a zip (or a plain file) to attributes and WKB, one dataset a member; members that are done are skipped."""
    if not source.lower().endswith(".zip"):
        return [_commit(geo.read_geojson(spark, source), Path(output, slug(Path(source).name)), source, {"kind": "geojson"})]
    out = []
    for m in archives.read_members(spark, source, depth=1).toLocalIterator():
        if not m["member"].lower().endswith(".geojson"):
            continue
        target = Path(output, slug(Path(source).stem), slug(m["member"]))
        if commit.is_complete(target, identity(source)):
            out.append({**commit.read_marker(target), "name": target.name, "state": "skipped"})
            continue
        local = Path(work, slug(m["member"]) + ".geojson")
        local.parent.mkdir(parents=True, exist_ok=True)
        local.write_bytes(bytes(m["content"]))
        try:
            out.append({**commit.commit(geo.read_geojson(spark, str(local)), target, identity(source), extra={"kind": "geojson"}), "name": target.name, "state": "done"})
        finally:
            local.unlink(missing_ok=True)
    return out


def convert_orders(spark: SparkSession, folder: str | Path, output: str | Path) -> list[dict[str, Any]]:
    """CSV files whose name begins with `Arrêtés`, types inferred; always written anew."""
    import shutil

    out = []
    for f in sorted(Path(folder).glob("Arrêtés*.csv")):
        target = Path(output, slug(f.stem))
        shutil.rmtree(target, ignore_errors=True)
        out.append(_commit(delimited.read_inferred(spark, str(f)), target, str(f), {"kind": "csv"}))
    return out


def write_manifest(records: list[dict[str, Any]], output: str | Path) -> dict[str, Any]:
    """Totals of a conversion, records in order of name."""
    keys = ("rows", "parts", "parquet_bytes")
    totals = {"datasets": sorted(records, key=lambda r: r["name"]), **{k: sum(r.get(k) or 0 for r in records) for k in keys}, "completed_at": utc_now()}
    atomic_json(Path(output, "manifest.json"), totals)
    return totals
