"""Applying a layout plan: nothing moves while there is a conflict."""

from __future__ import annotations

import os
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestack.operators import layout
from lodestack.sources import footers


class Conflict(RuntimeError):
    """The plan has conflicts; its first ones are the message."""


def state(spark: SparkSession, root: str, plan: DataFrame) -> DataFrame:
    """path, bytes, sha256, is_file of what a plan touches; only pairs of equal size are hashed."""
    base = str(Path(root).resolve())
    found = [(p.relative_to(base).as_posix(), p.stat().st_size, p.is_file()) for p in sorted(Path(base).rglob("*")) if not p.is_dir() or p.suffix == ".parquet"]
    sizes = spark.createDataFrame(found, "path string, bytes long, is_file boolean")
    hashed = footers.footers(layout.to_hash(plan, sizes).select(F.concat(F.lit(base + "/"), "path").alias("path")), checksum=True)
    digests = hashed.select(F.substring("path", F.lit(len(base) + 2), F.length("path")).alias("path"), "sha256")
    return sizes.join(digests, "path", "left")


def relative_files(spark: SparkSession, root: str) -> DataFrame:
    base = Path(root).resolve()
    return spark.createDataFrame([(p.relative_to(base).as_posix(),) for p in sorted(base.rglob("*.parquet")) if p.is_file()], "path string")


def apply(spark: SparkSession, root: str, planned: DataFrame) -> dict[str, int]:
    """Carry out a plan with actions: renames, and removal of sources whose equal is in place; empty folders go, deepest first."""
    conflicts = layout.first_conflicts(planned).collect()
    if conflicts:
        raise Conflict("; ".join(f"{c['source']}: {c['action']}" for c in conflicts))
    base, counts = Path(root), {"move": 0, "drop-source-duplicate": 0}
    folders: set[Path] = set()
    for r in planned.toLocalIterator():
        source, target = base / r["source"], base / r["destination"]
        if r["action"] == "move":
            target.parent.mkdir(parents=True, exist_ok=True)
            if target.exists():
                raise Conflict(f"{target} appeared meanwhile")
            os.rename(source, target)
        else:
            source.unlink()
        counts[r["action"]] += 1
        folders.add(source.parent)
    for f in sorted({p for x in folders for p in (x, *x.parents) if base in p.parents}, key=lambda p: -len(p.parts)):
        if f.is_dir() and not any(f.iterdir()):
            f.rmdir()
    return counts
