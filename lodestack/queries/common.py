"""Tables, and documents seen as a catalog of files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


FOLDERS = ("x-zip-y", "export au format csv", "vigieau", "tmp")


def entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """path, bytes, sha256, partial: each document as a file whose folder exercises the path rules."""
    d = table(spark, sf_dir, "documents")
    kind = F.col("doc_id") % 6
    folder = F.when(kind == 0, FOLDERS[0]).when(kind == 1, FOLDERS[1]).when(kind.isin(2, 4), FOLDERS[2]).when(kind == 3, FOLDERS[3]).otherwise(F.col("lang"))
    path = F.concat_ws("/", "source", folder, F.concat((F.col("doc_id") % 40).cast("string"), F.lit("-"), F.col("doc_id").cast("string"), F.lit(".txt")))
    return d.select(path.alias("path"), F.octet_length("text").cast("long").alias("bytes"), F.sha2("text", 256).alias("sha256"), (F.col("doc_id") % 50 == 0).alias("partial"))


ENTRIES = """
e as (
  select source || '/' || case doc_id % 6 when 0 then 'x-zip-y' when 1 then 'export au format csv' when 2 then 'vigieau' when 4 then 'vigieau' when 3 then 'tmp' else lang end
         || '/' || (doc_id % 40)::varchar || '-' || doc_id::varchar || '.txt' as path,
         strlen(text)::bigint as bytes, sha256(text) as sha256, doc_id % 50 = 0 as partial
  from documents),
p as (
  select *, len([x for x in string_split(path, '/') if x like '%.staging' or x like '.%' or x in ('_tmp', 'tmp')]) * 100
         + len([x for x in string_split(path, '/') if contains(lower(x), '-zip-') or lower(x) like '%.zip' or contains(lower(x), '-7z-') or lower(x) like '%.7z']) * 10
         + (contains(lower(path), 'export au format') or contains(lower(path), '/fichier csv') or contains(lower(path), '/fichier json'))::int as marks,
         len(string_split(path, '/')) as depth from e),
r as (
  select *, row_number() over (partition by sha256 order by marks, depth, length(path), path) as rn, count(*) over (partition by sha256) as copies,
         first_value(path) over (partition by sha256 order by marks, depth, length(path), path) as canonical_path from p),
dup as (
  select sha256, canonical_path, path as duplicate_path, bytes,
         case when contains(lower(canonical_path), 'vigieau/') and contains(lower(path), 'vigieau/') then 'snapshot-identical'
              when contains(lower(canonical_path), 'repertoire-national/') and contains(lower(path), 'repertoire-national/') then 'snapshot-identical'
              when (contains(lower(canonical_path), '-zip-') or contains(lower(canonical_path), '.zip/')) <> (contains(lower(path), '-zip-') or contains(lower(path), '.zip/')) then 'archive-vs-standalone'
              when contains(lower(canonical_path), 'export au format') or contains(lower(path), 'export au format') or contains(lower(canonical_path), 'fichier csv') or contains(lower(path), 'fichier csv')
                   or contains(lower(canonical_path), 'fichier json') or contains(lower(path), 'fichier json') then 'duplicate-export'
              when string_split(canonical_path, '/')[-1] = string_split(path, '/')[-1] then 'dataset-alias' else 'exact-duplicate' end as reason
  from r where rn > 1)
"""


def events_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as a migration log: source (a user), status, and the order of records."""
    e = table(spark, sf_dir, "events")
    kind = F.col("event_type")
    status = F.when(kind == "click", "done").when(kind == "view", "skip").when(kind == "purchase", "partial").when(kind == "error", "failed").otherwise("unsupported")
    return e.select(F.concat(F.lit("/raw/u"), F.col("user_id").cast("string")).alias("source"), status.alias("status"), F.lit(None).cast("string").alias("error"), F.lit("").alias("reason"), kind.alias("kind"), F.col("ts").alias("log"), F.col("event_id").alias("at"), "value")


LOG = """
g as (
  select '/raw/u' || user_id::varchar as source, case event_type when 'click' then 'done' when 'view' then 'skip' when 'purchase' then 'partial' when 'error' then 'failed' else 'unsupported' end as status,
         event_type as kind, ts, event_id, value from events),
l as (select * from (select *, row_number() over (partition by source order by ts desc, event_id desc) as rn from g) where rn = 1)
"""
CLASS = "case when status in ('done', 'skip') then 'complete' when status = 'partial' then 'partial' when status = 'failed' then 'missing' when status = 'unsupported' then 'ignored' else 'unknown' end"


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh folder in the one that driver and executors share (spark.checkpoint.dir; a local one where that is unset)."""
    import tempfile
    import uuid

    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not root:
        root = "file://" + tempfile.mkdtemp(prefix="lodestack-")
        spark.conf.set("spark.checkpoint.dir", root)
    return f"{root.rstrip('/')}/lodestack-{name}-{uuid.uuid4().hex}"


def local(path: str) -> str:
    """A path of the shared folder as the driver's own file system sees it."""
    return path.removeprefix("file://") if path.startswith("file://") else path.removeprefix("file:")


def one_file(lines: DataFrame, path: str, head: str = "", tail: str = "", gzipped: bool = False) -> str:
    """Lines, in the order of lines' partitions, as one text file: tasks write the parts, which are then put one behind another."""
    import gzip
    import shutil
    from pathlib import Path

    lines.write.text(path + ".parts")
    Path(local(path)).parent.mkdir(parents=True, exist_ok=True)
    with (gzip.open if gzipped else open)(local(path), "wb") as out:
        out.write(head.encode())
        for part in sorted(Path(local(path + ".parts")).glob("part-*")):
            with part.open("rb") as f:
                shutil.copyfileobj(f, out)
        out.write(tail.encode())
    shutil.rmtree(local(path + ".parts"))
    return path
