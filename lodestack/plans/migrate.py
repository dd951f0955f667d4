"""Migration of a raw tree: sniff every file, read it by its kind with fallbacks, commit, log."""

from __future__ import annotations

import json
import re
import shutil
import threading
import uuid
from collections import Counter
from collections.abc import Iterable, Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from pathlib import Path
from typing import Any
from urllib.parse import unquote

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodestack.functions import names, sniff
from lodestack.operators import layout
from lodestack.plans import commit
from lodestack.sources import archives, delimited, geo, jsonfiles, plain, sheets
from lodestack.plans.snapshots import slug
from lodestack.sources.files import append_jsonl, atomic_json, identity, utc_now

#: Levels of archives within archives.
DEPTH = 4
ARCHIVES = ("zip", "7z")
#: Files that hold several tables.
SEVERAL = ("gpkg", "sqlite", "xlsx", "xls", "ods", "spreadsheetml")
#: Files that are migrated at once.
WORKERS = 4
#: Files of at most so many bytes go together, at most so many of one kind and header in a job.
SMALL, TOGETHER = 1 << 20, 2000
#: The settings for the tasks that look up the paths of a job (else one a path), and for what a small file counts in a task.
LISTING, OPENING = "spark.sql.sources.parallelPartitionDiscovery.parallelism", "spark.sql.files.openCostInBytes"
# Folders that have jobs of their own, and kinds of files that can go side by side.
HANDLED = (
    "territoire-geospatial/cadastre/batiments/base-donnees-nationale", "territoire-geospatial/cadastre/batiments/imope", "socio-economie/equipements/accessibilite/localisation-acces-population",
    "climat-environnement/secheresse/vigieau", "tourisme/offre-nationale/datatourisme",
)
SIDE_BY_SIDE = ("parquet", "csv", "tsv", "csv.gz", "json", "json.gz", "geojson", "kml", "shapefile", "gpkg", "sqlite", "xlsx", "xls", "ods", "spreadsheetml", "zip", "7z")


_LOGGING = threading.Lock()


class Unsupported(ValueError):
    pass


@F.pandas_udf(T.StringType())
def _payload(content: pd.Series) -> pd.Series:
    return content.map(lambda x: sniff.payload(bytes(x)))


def listing(spark: SparkSession, root: str) -> DataFrame:
    """path, relative, bytes, kind, output of every file below root. Bytes are read only where the name doesn't tell the kind."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
    base = str(root).replace("file://", "").rstrip("/")
    plain_path = F.regexp_replace("path", "^file:(//)?", "")
    kind = F.coalesce(sniff.by_suffix(F.col("path")), sniff.kind(F.col("path"), F.col("content")))
    rows = files.select(plain_path.alias("path"), F.col("length").alias("bytes"), F.when(kind == "gzip", _payload("content")).otherwise(kind).alias("kind"))
    relative = F.substring("path", F.lit(len(base) + 2), F.length("path"))
    return rows.select("path", relative.alias("relative"), "bytes", "kind", F.concat(relative, F.lit(".parquet")).alias("output"))


def side_by_side(path: str, kind: str) -> bool:
    """Whether a file may be migrated beside others: of a kind that takes little memory, or without a suffix."""
    return kind in SIDE_BY_SIDE or (kind == "unknown" and not Path(path).suffix)


def selected(files: DataFrame, handled: Iterable[str] = HANDLED) -> DataFrame:
    """Files outside folders that other jobs handle, and outside hidden folders."""
    out = files.filter(~F.exists(F.split("relative", "/"), lambda p: p.startswith(".")))
    for prefix in handled:
        out = out.filter(~F.col("relative").startswith(prefix.rstrip("/") + "/"))
    return out


def preflight(files: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Files and bytes by kind; and outputs that more than one file would write."""
    kinds = files.groupBy("kind").agg(F.count("*").alias("files"), F.sum("bytes").alias("bytes")).orderBy(F.desc("files"), "kind")
    return kinds, layout.collisions(files)


def reader(spark: SparkSession, path: str, kind: str) -> tuple[DataFrame, str]:
    """A file's rows and the name of their representation; GeoJSON that isn't whole and KML that can't be read fall back."""
    if kind in ("csv", "tsv", "csv.gz"):
        return delimited.read_any(spark, path, kind.endswith(".gz"))
    if kind in ("json", "json.gz"):
        shape = jsonfiles.layout(path, kind.endswith(".gz"))
        if shape == "array":
            return jsonfiles.read_array(spark, path), "lossless-json-text"
        if shape == "lines":
            return jsonfiles.read_lines(spark, path), "lossless-json-lines"
        if shape == "object":
            return jsonfiles.read_object(spark, path), "lossless-top-level-object-json"
        raise Unsupported(f"JSON that is {shape}")
    if kind == "geojson":
        return geo.attributes(geo.read_geojson(spark, path)), "geo"
    if kind == "geojson.gz":
        return jsonfiles.read_features(spark, path), "lossless-geojson-feature-text"
    if kind == "shapefile":
        return geo.attributes(geo.read_shapefile(spark, path)), "geo"
    if kind == "kml":
        return geo.attributes(geo.read_kml(spark, path)), "geo"
    if kind == "text":
        return plain.read_lines(spark, path), "lossless-text-lines"
    if kind == "blob":
        return plain.read_blob(spark, path), "lossless-binary-blob"
    raise Unsupported(f"no reader for {kind}")


def salvaged(spark: SparkSession, path: str, kind: str) -> DataFrame | None:
    """Rows of a cut JSON or GeoJSON file up to the cut, with the error on the last; None for other kinds."""
    if kind in ("json", "json.gz", "geojson", "geojson.gz"):
        return jsonfiles.salvage(spark, path, "features" if kind.startswith("geojson") else None)
    return None


def migrate_file(spark: SparkSession, path: str, kind: str, target: Path, log: Path | None = None, depth: int = DEPTH, source: str | None = None) -> dict[str, Any]:
    """Migrate one file to target and return its log record (status done, skip, partial, failed or unsupported)."""
    record: dict[str, Any] = {"time": utc_now(), "source": source or path, "output": str(target), "kind": kind}
    who = identity(path)
    try:
        if commit.is_complete(target, who):
            record |= {"status": "skip", "rows": commit.read_marker(target)["rows"]}
        elif kind == "parquet":
            record |= {"status": "done", "representation": "parquet", **_facts(commit.commit_file(path, target, who, extra={"kind": kind, "representation": "parquet"}))}
        elif kind in SEVERAL:
            record |= _several(spark, path, kind, target, who)
        elif kind in ARCHIVES:
            record |= _archive(spark, path, target, who, log, depth, record["source"])
        else:
            df, representation = reader(spark, path, kind)
            record |= {"status": "done", "representation": representation, **_facts(commit.commit(df, target, who, extra={"kind": kind, "representation": representation}))}
    except Unsupported as e:
        record |= {"status": "unsupported", "reason": str(e)}
    except Exception as e:
        record |= {"status": "failed", "error": f"{type(e).__name__}: {str(e)[:500]}"}
        rest = salvaged(spark, path, kind)
        whole = jsonfiles.read_features(spark, path) if kind == "geojson" and _is_whole(rest) else None
        if whole is not None:  # the features can be read, but a geometry can't
            record |= {"status": "done", "representation": "lossless-geojson-feature-text", **_facts(commit.commit(whole, target, who, extra={"kind": kind, "representation": "lossless-geojson-feature-text"}))}
        elif rest is not None:
            record |= _partial(rest, target, who, record["error"])
        elif kind == "kml":
            blob, representation = reader(spark, path, "blob")
            record |= {"status": "done", "representation": representation, **_facts(commit.commit(blob, target, who, extra={"kind": kind, "representation": representation}))}
    if log is not None:
        with _LOGGING:
            append_jsonl(log, record)
    return record


def _several(spark: SparkSession, path: str, kind: str, target: Path, who: dict[str, Any]) -> dict[str, Any]:
    """A dataset for each layer or sheet, in a folder whose marker is written last; those that are done are skipped."""
    if kind in ("gpkg", "sqlite"):
        rows = geo.read_geopackage(spark, path)
        names_ = [r[0] for r in rows.select("layer").distinct().orderBy("layer").collect()]
        parts, representation = [(n, geo.attributes(rows.filter(F.col("layer") == n).drop("layer"))) for n in names_], "geo-layers"
    else:
        parts, representation = sheets.tables(spark, path), "sheets"
    outputs = [slug(n) for n, _ in parts]
    if len(set(outputs)) < len(outputs):
        raise commit.CommitError(f"several parts of {path} have one name: {sorted(outputs)}")
    facts = []
    for name, (_, df) in zip(outputs, parts):
        place = target / f"{name}.parquet"
        done = commit.is_complete(place, who)
        facts.append(_facts(commit.read_marker(place) if done else commit.commit(df, place, who, extra={"kind": kind, "representation": representation})))
    total = {k: sum(f[k] for f in facts) for k in ("rows", "bytes")}
    target.mkdir(parents=True, exist_ok=True)
    atomic_json(target / commit.MARKER, {"source": who, "rows": total["rows"], "parts": len(parts), "parquet_bytes": total["bytes"], "completed_at": utc_now()})
    return {"status": "done", "representation": representation, **total}


def _is_whole(rows: DataFrame | None) -> bool:
    return rows is not None and rows.filter("error is not null").isEmpty()


def _facts(marker: dict[str, Any]) -> dict[str, Any]:
    return {"rows": marker["rows"], "bytes": marker["parquet_bytes"]}


def _partial_of(target: Path) -> Path:
    return target.with_name(re.sub(r"\.parquet$", "", target.name) + ".partial.parquet")


def _partial(rows: DataFrame, target: Path, who: dict[str, Any], error: str) -> dict[str, Any]:
    """Commit what could be read as `*.partial.parquet`, with a sidecar that tells why."""
    part = _partial_of(target)
    if commit.is_complete(part, who):
        return {"status": "partial", "output": str(part), **_facts(commit.read_marker(part))}
    shutil.rmtree(part, ignore_errors=True)  # of an earlier version of the source
    good = rows.filter("error is null").select("json")
    if good.isEmpty():
        return {}
    return _sidecar(commit.commit(good, part, who, extra={"partial": True}), part, who, error)


def _sidecar(marker: dict[str, Any], part: Path, who: dict[str, Any], error: str) -> dict[str, Any]:
    atomic_json(part.with_suffix(".json"), {"status": "partial", "source": who, "output": str(part), "rows_recovered": marker["rows"], "error": error, "created_at": utc_now()})
    return {"status": "partial", "output": str(part), **_facts(marker)}


def _archive(spark: SparkSession, path: str, target: Path, who: dict[str, Any], log: Path | None, depth: int, source: str) -> dict[str, Any]:
    """Migrate an archive's members into a folder; its marker is written only if no member failed. Partial members are counted."""
    if depth < 1:
        raise Unsupported("archives within archives are too deep")
    folder = target.with_name(f".{target.name}.{uuid.uuid4().hex}.members")  # beside the output, where executors see it
    counts: dict[str, int] = {}
    rows = 0
    try:
        for m in archives.read_members(spark, path, depth=1).toLocalIterator():
            name = m["member"]
            if m["content"] is None:
                counts["failed"] = counts.get("failed", 0) + 1
                continue
            local = folder / name
            local.parent.mkdir(parents=True, exist_ok=True)
            local.write_bytes(bytes(m["content"]))
        for local in sorted(p for p in folder.rglob("*") if p.is_file()):
            name = local.relative_to(folder).as_posix()
            kind = listing(spark, str(local)).first()["kind"]
            if kind == "non-tabular":
                continue
            got = migrate_file(spark, str(local), kind, target / f"{name}.parquet", log, depth - 1, f"{source}!{name}")
            counts[got["status"]] = counts.get(got["status"], 0) + 1
            rows += got.get("rows") or 0
    finally:
        shutil.rmtree(folder, ignore_errors=True)
    if counts.get("failed"):
        return {"status": "failed", "error": f"{counts['failed']} members failed", "members": counts}
    target.mkdir(parents=True, exist_ok=True)
    atomic_json(target / commit.MARKER, {"source": who, "rows": rows, "members": counts, "completed_at": utc_now()})
    return {"status": "done", "rows": rows, "members": counts}


def shaped(files: DataFrame, output: str | Path) -> DataFrame:
    """files with shape: of small files that can be read together, what they must have in common (JSON text), else null. Tasks read the beginnings."""
    columns = ["path", "relative", "bytes", "kind", "output"]

    def shape(path: str, size: int, kind: str, target: str) -> str | None:
        if size > SMALL or re.search(r"[\[\]{}*?\\]", path) or Path(output, target).exists():
            return None
        try:
            if kind in ("json", "json.gz"):
                return json.dumps([kind]) if jsonfiles.layout(path, kind.endswith(".gz")) == "array" else None
            if kind not in ("csv", "tsv", "csv.gz"):
                return None
            header, delimiter = delimited.dialect(path, kind.endswith(".gz"))
        except Exception:  # said by the file's own migration
            return None
        plain_names = all(c.strip() and not re.search(r"[`,;{}()\n\r\t=]", c) and not c.startswith("_lodestack") for c in header)
        return json.dumps([kind, delimiter, *header]) if header and plain_names and len({c.lower() for c in header}) == len(header) else None

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            shapes = [shape(p, b, k, o) for p, b, k, o in zip(*(batch.column(c).to_pylist() for c in ("path", "bytes", "kind", "output")))]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(shapes, pa.string())], [*batch.schema.names, "shape"])

    return files.select(*columns).mapInArrow(look, "path string, relative string, bytes long, kind string, output string, shape string")


OUTCOME = "path string, outcome string"


def _outcomes(found: Iterable[tuple[str, dict[str, Any]]]) -> Iterator[pa.RecordBatch]:
    for path, outcome in found:
        yield pa.RecordBatch.from_arrays([[path], [json.dumps(outcome)]], ["path", "outcome"])


def _plain_path(uri: str) -> str:
    return re.sub("^file:(//)?", "", uri)


def _committing(targets: dict[str, str], extra: dict[str, Any], skip: int):
    """Writes each file's rows, which follow each other, as its dataset: columns FILE, BAD, then the data from column `skip` on (a column `none` marks no row)."""

    def done(path: str, held: list[pa.RecordBatch], bad: bool) -> Iterator[tuple[str, dict[str, Any]]]:
        if path in targets and bad:
            yield path, {"status": "bad"}
        elif path in targets:
            who = identity(path)
            marker = commit.read_marker(targets[path]) if commit.is_complete(targets[path], who) else commit.commit_table(pa.Table.from_batches(held), targets[path], who, extra=extra)
            yield path, {"status": "done", "representation": extra["representation"], **_facts(marker)}

    def files(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, dict[str, Any]]]:
        path, held, bad = None, [], False
        for batch in batches:
            names_, flags = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            cuts = [0, *(i for i in range(1, len(names_)) if names_[i] != names_[i - 1]), len(names_)]
            for a, b in zip(cuts, cuts[1:]):
                if a == b:
                    continue
                if (here := unquote(_plain_path(names_[a]))) != path:
                    if path is not None:
                        yield from done(path, held, bad)
                    path, held, bad = here, [], False
                part = batch.slice(a, b - a)
                bad = bad or any(flags[a:b])
                if skip > 2 and not bad:
                    part = part.filter(pa.array([not x for x in part.column(2).to_pylist()]))
                held.append(pa.RecordBatch.from_arrays(part.columns[skip:], part.schema.names[skip:]))
        if path is not None:
            yield from done(path, held, bad)

    return lambda batches: _outcomes(files(batches))


def _salvaging(targets: dict[str, str], error: str):
    """What can be saved of cut JSON files, as _partial does."""

    def files(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, dict[str, Any]]]:
        for batch in batches:
            for uri, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                path = _plain_path(uri)
                if path not in targets:
                    continue
                part, who = _partial_of(Path(targets[path])), identity(path)
                items, _ = jsonfiles.salvaged(path, data)
                outcome = {"status": "failed", "error": error}
                if commit.is_complete(part, who):
                    outcome |= {"status": "partial", "output": str(part), **_facts(commit.read_marker(part))}
                elif items:
                    shutil.rmtree(part, ignore_errors=True)  # of an earlier version of the source
                    outcome |= _sidecar(commit.commit_table(pa.table({"json": pa.array(items, pa.string())}), part, who, extra={"partial": True}), part, who, error)
                yield path, outcome

    return lambda batches: _outcomes(files(batches))


def migrate_together(spark: SparkSession, files: list, shape: str, output: str | Path, log: Path, alone) -> Counter:
    """Migrate small files of one shape in one job, whose tasks commit a file each after the other; counts by status.

    The readers are those of single files. Files that it can't settle go to alone(file); if the job fails, its halves are tried.
    """
    kind, *rest = json.loads(shape)
    targets = {f["path"]: str(Path(output, f["output"])) for f in files}
    try:
        if kind.startswith("json"):
            extra, rows, skip = {"kind": kind, "representation": "lossless-json-text"}, jsonfiles.read_arrays(spark, list(targets)), 3
        else:
            extra, rows, skip = {"kind": kind, "representation": "csv"}, delimited.read_strings_of(spark, list(targets), rest[1:], rest[0]), 2
        found = {r["path"]: json.loads(r["outcome"]) for r in rows.mapInArrow(_committing(targets, extra, skip), OUTCOME).collect()}
        bad = [p for p, x in found.items() if x["status"] == "bad"]
        if kind.startswith("json") and bad:
            content = spark.read.format("binaryFile").load(bad).select("path", "content")
            found |= {r["path"]: json.loads(r["outcome"]) for r in content.mapInArrow(_salvaging({p: targets[p] for p in bad}, "ValueError: not a whole JSON array"), OUTCOME).collect()}
    except Exception:
        if len(files) <= 8:
            return Counter(map(alone, files))
        half = len(files) // 2
        return migrate_together(spark, files[:half], shape, output, log, alone) + migrate_together(spark, files[half:], shape, output, log, alone)
    settled = {p: x for p, x in found.items() if x["status"] != "bad"}
    records = [{"time": utc_now(), "source": p, "output": targets[p], "kind": kind, **x} for p, x in settled.items()]
    if records:
        with _LOGGING:
            append_jsonl(log, *records)
    return Counter(r["status"] for r in records) + Counter(alone(f) for f in files if f["path"] not in settled)


def run(spark: SparkSession, root: str, output: str | Path, log: str | Path, handled: Iterable[str] = HANDLED, kinds: Iterable[str] | None = None, only: DataFrame | None = None, workers: int = WORKERS, floor: int | None = None) -> dict[str, int]:
    """Migrate all files below root (or those that only names by `source`); counts by status.

    Colliding outputs raise before anything is written. Small delimited files of one header, and small JSON
    arrays, are migrated many in a job (migrate_together). Other files that may go side by side do, at
    most `workers` at once, each in jobs of its own: what fails is logged for that file and the others
    go on. With floor, so many bytes must stay free on the output's disk before a file is begun.
    """
    files = selected(listing(spark, root), handled).filter("kind <> 'non-tabular'")
    if kinds is not None:
        files = files.filter(F.col("kind").isin(list(kinds)))
    if only is not None:
        files = files.join(only.select(F.col("source").alias("path")), "path", "left_semi")
    output = Path(output)
    listed = output.with_name(f".{output.name}.{uuid.uuid4().hex}.listing")  # beside the output, where executors see it
    try:
        with _settings(spark, LISTING, str(2 * spark.sparkContext.defaultParallelism)):
            found = shaped(files, output)
            with _settings(spark, OPENING, "131072"):
                found.write.parquet(str(listed))  # files are listed once; what is migrated meanwhile doesn't change it
            return _migrated(spark, spark.read.schema(found.schema).parquet(str(listed)), output, Path(log), workers, floor)
    finally:
        shutil.rmtree(listed, ignore_errors=True)


@contextmanager
def _settings(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    """A session setting for the time of a block."""
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def _migrated(spark: SparkSession, files: DataFrame, output: Path, log: Path, workers: int, floor: int | None) -> dict[str, int]:
    """Migrate shaped files: small ones of one shape together, others that may go side by side one by one, then the rest."""
    _, clash = preflight(files)
    if found := clash.take(1):
        raise commit.CommitError(f"several files would become {found[0]['output']}: {found[0]['paths']}")

    def one(f) -> str:
        if floor is not None:
            output.mkdir(parents=True, exist_ok=True)
            commit.free_space(output, f["bytes"], f["kind"].endswith(".gz"), floor)
        return migrate_file(spark, f["path"], f["kind"], output / f["output"], log)["status"]

    def several(part: list, shape: str | None) -> Counter:
        if shape is None or len(part) == 1:
            return Counter(map(one, part))
        if floor is not None:
            output.mkdir(parents=True, exist_ok=True)
            commit.free_space(output, sum(f["bytes"] for f in part), part[0]["kind"].endswith(".gz"), floor)
        return migrate_together(spark, part, shape, output, log, one)

    counts: Counter = Counter()
    alone: list = []

    def portions() -> Iterator[tuple[list, str | None]]:
        """Small files of one shape together, others that may go side by side one by one."""
        part: list = []
        for f in files.orderBy("shape", "relative").toLocalIterator():
            if part and (f["shape"] != part[0]["shape"] or len(part) == TOGETHER):
                yield part, part[0]["shape"]
                part = []
            if f["shape"] is not None:
                part.append(f)
            elif side_by_side(f["path"], f["kind"]):
                yield [f], None
            else:
                alone.append(f)
        if part:
            yield part, part[0]["shape"]

    with ThreadPoolExecutor(max(1, workers)) as pool:
        waiting: list = []
        for part, shape in portions():
            waiting.append(pool.submit(several, part, shape))
            if len(waiting) > 4 * workers:
                counts += waiting.pop(0).result()
        for w in waiting:
            counts += w.result()
    counts += Counter(map(one, alone))
    return dict(counts)


def stable_output(path) -> Any:
    """Output name of a path that can't collide: slug and digest."""
    return F.concat(names.stable_name(path), F.lit(".parquet"))
