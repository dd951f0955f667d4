"""Command line: python -m lodestack COMMAND ... Exit codes: 0 done, 1 error, 2 conflict or something missing, 130 interrupted."""

from __future__ import annotations

import argparse
import json
import sys
from pathlib import Path

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from lodestack.operators import layout, manifest, matching, reconcile, release, semantic, snapshot
from lodestack.plans import commit, convert, migrate, moves, snapshots
from lodestack.session import builder
from lodestack.sources import catalogs

LAYOUTS = {"prefix": layout.by_prefix, "dated": layout.by_dated_name, "year": layout.by_year_folder}


def _tell(value) -> None:
    print(json.dumps(value, ensure_ascii=False, default=str))


def convert_dump(spark: SparkSession, a) -> int:
    for record in convert.convert(spark, a.source, a.output, a.catalog, a.tables, a.allow_type_fallback, a.reference, a.dry_run, a.member):
        _tell(record)
    return 0


def migrate_tree(spark: SparkSession, a) -> int:
    only = None
    if a.preflight:
        kinds, clash = migrate.preflight(migrate.selected(migrate.listing(spark, a.root), a.handled or migrate.HANDLED))
        for r in kinds.collect():
            _tell(r.asDict())
        found = [r.asDict() for r in clash.collect()]
        _tell({"collisions": found})
        return 2 if found else 0
    if a.retry:
        sizes = migrate.listing(spark, a.root).select(F.col("path").alias("source"), "bytes")
        only = reconcile.retry_queue(catalogs.read_logs(spark, a.log), a.root, a.retry, sizes, a.kinds, a.min_size)
    counts = migrate.run(spark, a.root, a.output, a.log, a.handled or migrate.HANDLED, None if a.retry else a.kinds, only, floor=a.floor)
    _tell(counts)
    return 1 if counts.get("failed") else 0


def triples(spark: SparkSession, a) -> int:
    done = [snapshots.convert_triples(spark, s, a.output) if s.lower().endswith(".zip") else snapshots.convert_strings(spark, s, a.output) for s in sorted(a.sources)]
    _tell(snapshots.write_manifest(done, a.output))
    return 0


def features(spark: SparkSession, a) -> int:
    done = [r for s in sorted(a.sources) for r in snapshots.convert_features(spark, s, a.output, a.work)]
    done += snapshots.convert_orders(spark, a.csv_folder, a.output) if a.csv_folder else []
    _tell(snapshots.write_manifest(done, a.output))
    return 0


def audit(spark: SparkSession, a) -> int:
    def files(layer: str):
        root = Path(a.root, layer)
        if not root.exists():
            return spark.createDataFrame([], "path string, bytes long")
        rows = migrate.listing(spark, str(root))
        return rows.select(F.col("relative").alias("path"), "bytes")

    sets = [matching.inventory(files(x), x) for x in ("raw", "numpy", "parquet")]
    rows = matching.audit(*sets)
    catalogs.write_tsv(rows.orderBy("raw_path", "numpy_path", "parquet_path"), a.output)
    for r in matching.audit_summary(rows).collect():
        _tell(r.asDict())
    return 0


def build_manifest(spark: SparkSession, a) -> int:
    previous = spark.read.parquet(a.previous) if a.previous else None
    rows = manifest.build(spark, a.root, a.checksum, previous)
    rows.write.mode("overwrite").parquet(a.store)
    rows = spark.read.parquet(a.store)
    catalogs.write_tsv(rows.withColumn("partial", F.col("partial").cast("int")).orderBy("path"), a.output)
    totals = manifest.totals(rows).first().asDict()
    _tell(totals)
    return 2 if totals["errors"] else 0


def build_release(spark: SparkSession, a) -> int:
    entries = catalogs.read_manifest(spark, a.manifest)
    output = Path(a.output)
    if output.exists() and any(output.iterdir()):
        raise commit.CommitError(f"{output} isn't empty")
    kept = release.canonical(entries).orderBy("path")
    if a.mode:
        commit.materialise_release(a.root, [(r["path"], r["bytes"]) for r in kept.select("path", "bytes").toLocalIterator()], output, a.mode)
    catalogs.write_tsv(release.duplicates(entries).orderBy("canonical_path", "duplicate_path"), str(output / "_meta" / "duplicates.tsv"))
    catalogs.write_tsv(kept.select("path", "bytes", "sha256", F.col("partial").cast("int").alias("partial")), str(output / "_meta" / "manifest.tsv"))
    summary = release.summary(entries).first().asDict()
    from lodestack.sources.files import atomic_json

    atomic_json(output / "_meta" / "summary.json", summary)
    _tell(summary)
    return 0


def semantic_audit(spark: SparkSession, a) -> int:
    plan = catalogs.read_tsv(spark, a.duplicates).withColumn("bytes", F.col("bytes").cast("long"))
    for name, f in (("by-reason", semantic.by_reason), ("by-domain", semantic.by_domain), ("alias-candidates", semantic.alias_pairs), ("snapshot-groups", semantic.snapshot_groups)):
        catalogs.write_tsv(f(plan), str(Path(a.output, f"{name}.tsv")))
    return 0


def snapshot_index(spark: SparkSession, a) -> int:
    renames = snapshot.rename_map(catalogs.read_tsv(spark, a.renames).withColumn("at", F.monotonically_increasing_id()), "at") if a.renames else None
    rows = snapshot.index(catalogs.read_tsv(spark, a.duplicates), catalogs.read_tsv(spark, a.manifest), renames)
    catalogs.write_tsv(rows, a.output)
    summary = [r.asDict() for r in snapshot.index_summary(rows).collect()]
    for r in summary:
        _tell(r)
    return 2 if any(r["missing_current"] for r in summary) else 0


def reconcile_logs(spark: SparkSession, a) -> int:
    raw = str(Path(a.root, "raw"))
    sizes = migrate.listing(spark, raw).select(F.col("path").alias("source"), "bytes")
    rows = reconcile.classify(catalogs.read_logs(spark, *a.logs), raw, sizes)
    catalogs.write_tsv(rows, a.output)
    for r in reconcile.totals(rows).collect():
        _tell(r.asDict())
    return 0


def promote(spark: SparkSession, a) -> int:
    _tell((commit.publish_partitions if a.by_partition else commit.publish_tree)(a.source, a.output))
    return 0


def normalize(spark: SparkSession, a) -> int:
    plan = LAYOUTS[a.layout](moves.relative_files(spark, a.root))
    planned = layout.actions(plan, moves.state(spark, a.root, plan))
    rows = [tuple(r) for r in planned.collect()]
    planned = spark.createDataFrame(rows, planned.schema)
    catalogs.write_tsv(planned.orderBy("source"), a.output)
    conflicts = layout.first_conflicts(planned).collect()
    for r in conflicts:
        _tell(r.asDict())
    if conflicts:
        return 2
    if a.apply:
        _tell(moves.apply(spark, a.root, planned))
    return 0


def parser() -> argparse.ArgumentParser:
    out = argparse.ArgumentParser(prog="lodestack", description=__doc__)
    commands = out.add_subparsers(required=True)

    def add(name: str, run, **options) -> None:
        p = commands.add_parser(name)
        p.set_defaults(run=run)
        for key, spec in options.items():
            p.add_argument("--" + key.replace("_", "-"), **({"required": True} if spec is None else spec))

    flag, optional, many = {"action": "store_true"}, {}, {"nargs": "+"}
    needed = {"nargs": "+", "required": True}
    add("convert", convert_dump, source=None, output=None, catalog=optional, tables=many, allow_type_fallback=flag, reference=optional, dry_run=flag, member=optional)
    add("migrate", migrate_tree, root=None, output=None, log=None, handled=many, kinds=many, retry=many, min_size={"type": int, "default": 0}, floor={"type": int, "default": 20 << 30}, preflight=flag)
    add("triples", triples, sources=needed, output=None)
    add("features", features, sources=needed, output=None, work=None, csv_folder=optional)
    add("audit", audit, root=None, output=None)
    add("manifest", build_manifest, root=None, store=None, output=None, checksum=flag, previous=optional)
    add("release", build_release, manifest=None, root=None, output=None, mode={"choices": ["hardlink", "copy"]})
    add("semantic-audit", semantic_audit, duplicates=None, output=None)
    add("snapshot-index", snapshot_index, duplicates=None, manifest=None, renames=optional, output=None)
    add("reconcile", reconcile_logs, root=None, logs=needed, output=None)
    add("promote", promote, source=None, output=None, by_partition=flag)
    add("normalize", normalize, root=None, output=None, layout={"choices": sorted(LAYOUTS), "default": "prefix"}, apply=flag)
    return out


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    a = parser().parse_args(argv)
    try:
        return a.run(spark or builder().getOrCreate(), a)
    except KeyboardInterrupt:
        return 130
    except moves.Conflict as e:
        print(e, file=sys.stderr)
        return 2
    except Exception as e:
        print(f"{type(e).__name__}: {e}", file=sys.stderr)
        return 1
