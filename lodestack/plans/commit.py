"""Staged commits of Parquet datasets: write beside, validate, put in place, mark."""

from __future__ import annotations

import json
import os
import shutil
import time
import uuid
from collections.abc import Iterator
from pathlib import Path
from typing import Any

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession

from lodestack.sources.files import atomic_json, utc_now

MARKER = "_SUCCESS.json"
#: Rows a part, and the Parquet settings of every writer.
PART_ROWS = 250_000
OPTIONS = {"compression": "zstd", "parquet.compression.codec.zstd.level": "3", "parquet.writer.version": "v2", "parquet.enable.dictionary": "true", "parquet.block.row.count.limit": "100000"}


class CommitError(RuntimeError):
    """What was written isn't what was read, or the target can't be written."""


def footer_rows(folder: Path) -> tuple[int, int, int]:
    """Rows, parts and bytes by the footers of a folder's Parquet files."""
    files = sorted(folder.rglob("*.parquet"))
    return sum(pq.read_metadata(f).num_rows for f in files), len(files), sum(f.stat().st_size for f in files)


def read_marker(folder: str | Path) -> dict[str, Any] | None:
    try:
        return json.loads(Path(folder, MARKER).read_text(encoding="utf-8"))
    except (OSError, ValueError):
        return None


def is_complete(folder: str | Path, identity: dict[str, Any]) -> bool:
    """Whether a commit of this very source is in place."""
    marker = read_marker(folder)
    return bool(marker) and marker.get("source") == identity and Path(folder).is_dir()


def add_footer_metadata(spark: SparkSession, folder: Path, metadata: dict[str, Any]) -> None:
    """Put key-value metadata into the footers of a folder's files: tasks copy a file each, group by group, beside itself."""
    extra = {k.encode(): (v if isinstance(v, str) else json.dumps(v, ensure_ascii=False, separators=(",", ":"))).encode() for k, v in metadata.items()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name in batch.column(0).to_pylist():
                f = Path(name)
                source = pq.ParquetFile(f)
                schema = source.schema_arrow.with_metadata({**(source.schema_arrow.metadata or {}), **extra})
                beside = f.with_suffix(f".{uuid.uuid4().hex}.tmp")  # another attempt of the task writes another file
                with pq.ParquetWriter(beside, schema, compression="zstd", compression_level=3) as w:
                    for k in range(source.num_row_groups):
                        w.write_table(source.read_row_group(k).replace_schema_metadata(schema.metadata))
                os.replace(beside, f)
                f.with_name(f".{f.name}.crc").unlink(missing_ok=True)
            yield pa.RecordBatch.from_arrays([batch.column(0)], ["path"])

    names = [str(f) for f in sorted(folder.rglob("*.parquet"))]
    rows = spark.createDataFrame([(n,) for n in names], "path string").repartition(max(1, len(names)))
    rows.mapInArrow(run, "path string").count()


def commit_table(table: pa.Table, target: str | Path, identity: dict[str, Any], part_rows: int = PART_ROWS, extra: dict[str, Any] | None = None) -> dict[str, Any]:
    """A table in memory as a dataset at target, without a job of Spark: staged, counted by its footers, put in place, marked."""
    target = Path(target)
    if target.exists():
        raise CommitError(f"{target} exists")
    staging = target.with_name(f".{target.name}.{uuid.uuid4().hex}.staging")
    began = time.time()
    try:
        staging.mkdir(parents=True)
        for k, i in enumerate(range(0, max(1, table.num_rows), part_rows)):
            pq.write_table(table.slice(i, part_rows), staging / f"part-{k:05d}.parquet", row_group_size=100_000, compression="zstd", compression_level=3, data_page_version="2.0")
        rows, parts, size = footer_rows(staging)
        if rows != table.num_rows:
            raise CommitError(f"{target.name}: {rows} rows in footers, {table.num_rows} read")
        marker = {"source": identity, "rows": rows, "parts": parts, "parquet_bytes": size, "elapsed_seconds": round(time.time() - began, 3), "completed_at": utc_now(), **(extra or {})}
        atomic_json(staging / MARKER, marker)
        os.replace(staging, target)
        return marker
    finally:
        shutil.rmtree(staging, ignore_errors=True)


def commit_file(source: str | Path, target: str | Path, identity: dict[str, Any], extra: dict[str, Any] | None = None) -> dict[str, Any]:
    """A Parquet file as a dataset at target, byte for byte: staged, its footer compared, put in place, marked."""
    source, target = Path(source), Path(target)
    if target.exists():
        raise CommitError(f"{target} exists")
    staging = target.with_name(f".{target.name}.{uuid.uuid4().hex}.staging")
    began = time.time()
    try:
        staging.mkdir(parents=True)
        shutil.copy2(source, staging / "part-00000.parquet")
        rows, parts, size = footer_rows(staging)
        if (rows, size) != (pq.read_metadata(source).num_rows, source.stat().st_size):
            raise CommitError(f"{source} changed while it was copied")
        marker = {"source": identity, "rows": rows, "parts": parts, "parquet_bytes": size, "elapsed_seconds": round(time.time() - began, 3), "completed_at": utc_now(), **(extra or {})}
        atomic_json(staging / MARKER, marker)
        os.replace(staging, target)
        return marker
    finally:
        shutil.rmtree(staging, ignore_errors=True)


def commit(df: DataFrame, target: str | Path, identity: dict[str, Any], expected_rows: int | None = None, part_rows: int = PART_ROWS, metadata: dict[str, Any] | None = None, extra: dict[str, Any] | None = None) -> dict[str, Any]:
    """Write df as a dataset at target and return its marker.

    Parts hold at most part_rows rows. Rows are counted while they are written; the footers, that count and
    expected_rows must agree before the folder is put in place, so nothing partial is ever
    seen there. An existing target raises; a failed commit leaves nothing behind.
    """
    from pyspark.sql import Observation
    from pyspark.sql import functions as F

    target = Path(target)
    if target.exists():
        raise CommitError(f"{target} exists")
    staging = target.with_name(f".{target.name}.{uuid.uuid4().hex}.staging")
    began, seen = time.time(), Observation()
    try:
        df.observe(seen, F.count(F.lit(1)).alias("rows")).write.options(**OPTIONS, maxRecordsPerFile=part_rows).mode("errorifexists").parquet(str(staging))
        if metadata:
            add_footer_metadata(df.sparkSession, staging, metadata)
        rows, parts, size = footer_rows(staging)
        counts = {"written": seen.get["rows"], "in footers": rows, **({} if expected_rows is None else {"expected": expected_rows})}
        if len(set(counts.values())) > 1:
            raise CommitError(f"{target.name}: rows differ: {counts}")
        (staging / "_SUCCESS").unlink(missing_ok=True)
        marker = {"source": identity, "rows": rows, "parts": parts, "parquet_bytes": size, "elapsed_seconds": round(time.time() - began, 3), "completed_at": utc_now(), **(extra or {})}
        atomic_json(staging / MARKER, marker)
        target.parent.mkdir(parents=True, exist_ok=True)
        os.replace(staging, target)
        return marker
    finally:
        shutil.rmtree(staging, ignore_errors=True)


def part_number(rank, rows: int = PART_ROWS):
    """Number of the part that the row of a rank (from 1) goes to."""
    from pyspark.sql import functions as F

    return F.floor((rank - 1) / rows)


def free_space(path: str | Path, source_bytes: int = 0, gzipped: bool = False, floor: int = 20 << 30) -> None:
    """Raise unless the local disk keeps the floor after a source (eight times its size if gzipped) is written."""
    free = shutil.disk_usage(path).free
    need = floor + source_bytes * (8 if gzipped else 1)
    if free < need:
        raise CommitError(f"{free} bytes are free, {need} are needed")


def publish_tree(source: str | Path, target: str | Path, copy: bool = False) -> dict[str, Any]:
    """Publish a validated Parquet tree by hard links (or copies): all of it or nothing.

    Every linked file's footer must be the source's; an existing target raises.
    """
    source, target = Path(source), Path(target)
    if target.exists():
        raise CommitError(f"{target} exists")
    files = sorted(source.rglob("*.parquet"))
    if not files:
        raise CommitError(f"no Parquet files below {source}")
    staging = target.with_name(f".{target.name}.{uuid.uuid4().hex}.staging")
    rows = size = geo = 0
    try:
        for f in files:
            to = staging / f.relative_to(source)
            to.parent.mkdir(parents=True, exist_ok=True)
            shutil.copy2(f, to) if copy else os.link(f, to)
            a, b = pq.read_metadata(f), pq.read_metadata(to)
            if (a.num_rows, a.num_row_groups, a.schema) != (b.num_rows, b.num_row_groups, b.schema) or f.stat().st_size != to.stat().st_size:
                raise CommitError(f"{f} changed while it was published")
            rows, size, geo = rows + a.num_rows, size + f.stat().st_size, geo + (b"geo" in (a.metadata or {}))
        totals = {"files": len(files), "rows": rows, "bytes": size, "geo_files": geo, "completed_at": utc_now()}
        atomic_json(staging / "manifest.json", totals)
        target.parent.mkdir(parents=True, exist_ok=True)
        os.replace(staging, target)
        return totals
    finally:
        shutil.rmtree(staging, ignore_errors=True)


def publish_partitions(source: str | Path, target: str | Path) -> dict[str, Any]:
    """publish_tree for each folder of source (such as one a department), and totals of all."""
    parts = {p.name: publish_tree(p, Path(target, p.name)) for p in sorted(Path(source).iterdir()) if p.is_dir()}
    keys = ("files", "rows", "bytes", "geo_files")
    totals = {"partitions": parts, **{k: sum(p[k] for p in parts.values()) for k in keys}, "completed_at": utc_now()}
    atomic_json(Path(target, "dataset.json"), totals)
    return totals


def materialise_release(root: str | Path, entries: list[tuple[str, int]], target: str | Path, mode: str = "hardlink") -> int:
    """Put the canonical files (relative path, bytes) of a release in an empty target; sizes are checked first."""
    root, target = Path(root), Path(target)
    if target.exists() and any(target.iterdir()):
        raise CommitError(f"{target} isn't empty")
    for path, size in entries:
        if (root / path).stat().st_size != size:
            raise CommitError(f"{path} has changed its size")
        to = target / path
        to.parent.mkdir(parents=True, exist_ok=True)
        if to.exists():
            raise CommitError(f"{to} exists")
        os.link(root / path, to) if mode == "hardlink" else shutil.copy2(root / path, to)
    return len(entries)
