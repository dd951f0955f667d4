"""Release, rollups, snapshots, logs, manifests, matching and layout plans."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestack.functions import names
from lodestack.operators import layout, manifest, matching, reconcile, release, semantic, snapshot
from lodestack.queries.common import CLASS, ENTRIES, LOG, entries, events_log, table
from lodestack.registry import query


@query(f"with {ENTRIES} select sha256, canonical_path, path, bytes, copies, rn > 1 as is_duplicate, coalesce(reason, 'canonical') as reason from r left join (select duplicate_path, reason from dup) on path = duplicate_path")
def dedup_release(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every entry with its content's canonical path, and why it is a duplicate."""
    e = entries(spark, sf_dir)
    best = release.canonical(e).select("sha256", F.col("path").alias("canonical_path"), "copies")
    duplicate = F.col("path") != F.col("canonical_path")
    reason = F.when(duplicate, release.duplicate_reason(F.col("canonical_path"), F.col("path"))).otherwise("canonical")
    return e.join(best, "sha256").select("sha256", "canonical_path", "path", "bytes", "copies", duplicate.alias("is_duplicate"), reason.alias("reason"))


@query(f"with {ENTRIES} select sha256, canonical_path, duplicate_path, bytes, reason from dup")
def release_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return release.duplicates(entries(spark, sf_dir))


@query(f"""with {ENTRIES} select count(*) as source_files, count(distinct sha256) as release_files, count(*) - count(distinct sha256) as removed_files,
  count(*) filter (rn = 1 and copies > 1) as duplicate_groups, sum(bytes)::bigint as source_bytes, sum(bytes) filter (rn = 1)::bigint as release_bytes, sum(bytes) filter (rn > 1)::bigint as removed_bytes, count(*) filter (partial) as partial_files from r""")
def release_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return release.summary(entries(spark, sf_dir))


@query(f"with {ENTRIES} select reason, count(*) as duplicate_files, sum(bytes)::bigint as bytes, printf('%.3f', sum(bytes) / 1073741824.0) as gib from dup group by 1")
def semantic_by_reason(spark: SparkSession, sf_dir: str) -> DataFrame:
    return semantic.by_reason(release.duplicates(entries(spark, sf_dir)))


@query(f"with {ENTRIES} select string_split(duplicate_path, '/')[1] as domain, count(*) as duplicate_files, sum(bytes)::bigint as bytes, printf('%.3f', sum(bytes) / 1073741824.0) as gib from dup group by 1")
def semantic_by_domain(spark: SparkSession, sf_dir: str) -> DataFrame:
    return semantic.by_domain(release.duplicates(entries(spark, sf_dir)))


@query(f"with {ENTRIES}, d2 as (select reason, string_split(duplicate_path, '/')[1] as domain, bytes from dup) select reason, domain, count(*) as files, sum(bytes)::bigint as bytes from d2 group by grouping sets ((reason), (domain), ())")
def semantic_grouping_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return semantic.both(release.duplicates(entries(spark, sf_dir)))


@query(f"""with {ENTRIES} select reason, count(*) as files, sum(bytes)::bigint as bytes, printf('%.3f', sum(bytes) / 1048576.0) as mib, regexp_replace(canonical_path, '/[^/]*$', '') as canonical_parent, regexp_replace(duplicate_path, '/[^/]*$', '') as duplicate_parent
  from dup where reason in ('dataset-alias', 'exact-duplicate', 'duplicate-export') group by reason, canonical_parent, duplicate_parent""")
def alias_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return semantic.alias_pairs(release.duplicates(entries(spark, sf_dir)))


@query(f"""with {ENTRIES} select sha256, canonical_path, count(*) + 1 as logical_versions, sum(bytes)::bigint as duplicate_bytes, printf('%.3f', sum(bytes) / 1048576.0) as duplicate_mib, string_agg(duplicate_path, ';' order by duplicate_path) as duplicate_paths
  from dup where reason = 'snapshot-identical' group by 1, 2""")
def snapshot_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return semantic.snapshot_groups(release.duplicates(entries(spark, sf_dir)))


@query(f"""with {ENTRIES}, now as (select sha256, count(*) as n, min(path) as one, list(path) as paths from r where rn <= 2 group by 1)
  select d.sha256, case when list_contains(paths, canonical_path) then canonical_path when n = 1 then one else '' end as current_path, duplicate_path as historical_path,
         '' as snapshot_date, bytes, 'identical-snapshot' as relation from dup d left join now using (sha256) where reason = 'snapshot-identical'""")
def snapshot_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Removed snapshots and where their content is among the first two entries of each content."""
    from pyspark.sql import Window

    e = entries(spark, sf_dir)
    order = Window.partitionBy("sha256").orderBy(release.path_penalty(F.col("path")))
    now = e.withColumn("rn", F.row_number().over(order)).filter("rn <= 2")
    return snapshot.index(release.duplicates(e), now)


RENAMES = "select 'n' || n_nationkey::varchar as source, 'n' || (case when n_nationkey in (4, 9) then 4 + 9 - n_nationkey when n_nationkey = 12 then 12 else n_nationkey + n_regionkey + 1 end)::varchar as destination from nation where n_nationkey % 7 <> 0"


@query(f"""with recursive m as ({RENAMES}),
  s(origin, cur, seen) as (select source, source, []::varchar[] from m union all select s.origin, m.destination, list_append(s.seen, m.source) from s join m on s.cur = m.source where not list_contains(s.seen, s.cur))
  select origin as source, arg_max(cur, len(seen)) as current from s group by origin""")
def rename_closure(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chains, a cycle of two and a self-loop among renames made of nations."""
    k = F.col("n_nationkey")
    to = F.when(k.isin(4, 9), 13 - k).when(k == 12, 12).otherwise(k + F.col("n_regionkey") + 1)
    n = table(spark, sf_dir, "nation").filter(k % 7 != 0)
    moves = n.select(F.concat(F.lit("n"), k.cast("string")).alias("source"), F.concat(F.lit("n"), to.cast("string")).alias("destination"), F.lit("move").alias("action"))
    return snapshot.resolve(snapshot.rename_map(moves))


@query(f"with {LOG} select source, status, kind, {CLASS} as class from l")
def latest_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    last = reconcile.latest(events_log(spark, sf_dir), "source", ["log", "at"], "status", "kind")
    return last.select("source", "status", "kind", reconcile.status_class(F.col("status")).alias("class"))


@query(f"with {LOG}, s as (select '/raw/u' || user_id::varchar as source, count(*)::bigint as bytes from events group by 1) select replace(source, '/raw/', '') as raw_path, {CLASS} as class, bytes, printf('%.6f', bytes / 1073741824.0) as gib, kind as reason from l join s using (source)")
def reconcile_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = events_log(spark, sf_dir)
    return reconcile.classify(log, "/raw", log.groupBy("source").agg(F.count("*").alias("bytes")))


@query(f"with {LOG}, s as (select '/raw/u' || user_id::varchar as source, count(*)::bigint as bytes from events group by 1) select {CLASS} as class, count(*) as files, sum(bytes)::bigint as bytes, printf('%.3f', sum(bytes) / 1073741824.0) as gib from l join s using (source) group by 1")
def reconcile_by_class(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = events_log(spark, sf_dir)
    return reconcile.totals(reconcile.classify(log, "/raw", log.groupBy("source").agg(F.count("*").alias("bytes"))))


@query(f"with {LOG}, s as (select '/raw/u' || user_id::varchar as source, count(*)::bigint as bytes from events group by 1) select source, status, kind, bytes from l join s using (source) where status in ('failed', 'unsupported') and bytes >= 5")
def retry_queue(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = events_log(spark, sf_dir)
    return reconcile.retry_queue(log, "/raw", ["failed", "ignored"], log.groupBy("source").agg(F.count("*").alias("bytes")), min_size=5)


def _parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as a manifest: one file a customer."""
    o = table(spark, sf_dir, "orders")
    return o.groupBy("o_custkey").agg(F.count("*").alias("rows"), F.sum(F.length("o_orderpriority").cast("long")).alias("bytes"), F.min("o_orderpriority").alias("schema_hash")).select(
        F.concat(F.lit("d"), (F.col("o_custkey") % 5).cast("string"), F.lit("/c"), F.col("o_custkey").cast("string")).alias("path"), "bytes", "rows", "schema_hash", (F.col("o_custkey") % 11 == 0).alias("partial"),
        F.lit(None).cast("string").alias("error"), (F.col("o_custkey") % 3 == 0).alias("geo"),
    )


PARTS = "m as (select 'd' || (o_custkey % 5)::varchar || '/c' || o_custkey::varchar as path, count(*) as rows, sum(length(o_orderpriority))::bigint as bytes, min(o_orderpriority) as schema_hash, o_custkey % 11 = 0 as partial, o_custkey % 3 = 0 as geo from orders group by o_custkey)"


@query(f"with {PARTS} select count(*) as files, sum(bytes)::bigint as bytes, sum(rows)::bigint as rows, count(distinct schema_hash) as schemas, count(*) filter (partial) as partial_files, 0::bigint as errors from m")
def manifest_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest.totals(_parts(spark, sf_dir))


@query(f"with {PARTS} select string_split(path, '/')[1] as dataset, count(*) as files, sum(rows)::bigint as rows, sum(bytes)::bigint as bytes, count(*) filter (geo) as geo_files from m group by rollup(dataset)")
def dataset_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest.dataset_totals(_parts(spark, sf_dir))


@query(f"""with {PARTS}, old as (select path, case when rows % 2 = 0 then bytes else bytes + 1 end as old_bytes, case when rows % 3 = 0 then '' else schema_hash end as old_sha from m where rows > 3)
  select m.path, m.bytes, coalesce(m.bytes = old_bytes and old_sha <> '', false) as reuse from m left join old using (path)""")
def incremental_reuse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which entries of an earlier manifest still hold."""
    files = _parts(spark, sf_dir).withColumn("mtime", F.lit(0))
    old = files.filter("rows > 3").select("path", F.when(F.col("rows") % 2 == 0, F.col("bytes")).otherwise(F.col("bytes") + 1).alias("bytes"), "mtime", F.when(F.col("rows") % 3 == 0, "").otherwise(F.col("schema_hash")).alias("sha256"))
    known, rest = manifest.split_known(files.select("path", "bytes", "mtime"), old, True)
    return known.select("path", "bytes", F.lit(True).alias("reuse")).unionByName(rest.select("path", "bytes", F.lit(False).alias("reuse")))


@query("select doc_id, source from documents d where not exists (select 1 from labels l where l.doc_id = d.doc_id)")
def anti_orphans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", "source").join(table(spark, sf_dir, "labels"), "doc_id", "left_anti")


@query("select p_partkey as requested from part except select l_partkey from lineitem where l_quantity > 49")
def semi_requested(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Requested parts that no large line item has."""
    done = table(spark, sf_dir, "lineitem").filter("l_quantity > 49").select("l_partkey")
    return table(spark, sf_dir, "part").select(F.col("p_partkey").alias("requested")).exceptAll(done.distinct().select(F.col("l_partkey").alias("requested")))


@query("select d.doc_id, d.n_chars = length(d.text) as counts_agree, l.quality is null as unlabelled from documents d left join labels l using (doc_id)")
def reference_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Left join with a reference and comparison of what both say."""
    d, ref = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels").select("doc_id", "quality")
    return d.select("doc_id", (F.col("n_chars") == F.length("text")).alias("counts_agree")).join(ref, "doc_id", "left").select("doc_id", "counts_agree", F.col("quality").isNull().alias("unlabelled"))


def _layers(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Datasets of three layers, one of every part in each: paths that match by every rule, and paths that none does."""
    p = table(spark, sf_dir, "part")
    word = F.lower(F.regexp_replace("p_name", "[^A-Za-z0-9]+", " "))
    brand = F.lower(F.regexp_replace("p_brand", "[^A-Za-z0-9]+", "-"))
    key = F.col("p_partkey")

    def layer(path):
        return p.select(path.alias("relative_path"), F.col("p_size").cast("long").alias("bytes"), F.lit(1).alias("files"), F.lit(".csv:1").alias("formats"))

    name = F.concat(word, F.lit(" "), key.cast("string"))
    raw = layer(F.concat(brand, F.lit("/"), name))
    lost = F.concat(F.lit("attic/x"), key.cast("string"))
    numpy = layer(F.when(key % 4 != 0, lost).when(key % 3 == 0, F.concat(brand, F.lit("/"), name)).when(key % 3 == 1, F.concat(F.lit("other/"), F.replace(name, F.lit(" "), F.lit("-")))).otherwise(F.concat(brand, F.lit("/"), name, F.lit("/part"))))
    parquet = layer(F.when(key % 6 != 0, lost).when(key % 5 == 0, F.concat(brand, F.lit("/"), F.replace(name, F.lit(" "), F.lit("_")))).otherwise(F.concat(brand, F.lit("/"), name, F.lit(" bis"))))
    return raw, numpy, parquet


_NAME = "lower(regexp_replace(p_name, '[^A-Za-z0-9]+', ' ', 'g')) || ' ' || p_partkey::varchar"
LAYERS = f"""
q as (select p_partkey as k, p_size::bigint as bytes, lower(regexp_replace(p_brand, '[^A-Za-z0-9]+', '-', 'g')) as brand, {_NAME} as name from part),
raw as (select brand || '/' || name as path, bytes from q),
np as (select case when k % 4 <> 0 then 'attic/x' || k::varchar when k % 3 = 0 then brand || '/' || name when k % 3 = 1 then 'other/' || replace(name, ' ', '-') else brand || '/' || name || '/part' end as path, bytes from q),
pqt as (select case when k % 6 <> 0 then 'attic/x' || k::varchar when k % 5 = 0 then brand || '/' || replace(name, ' ', '_') else brand || '/' || name || ' bis' end as path, bytes from q),
norm as (select path, trim(regexp_replace(lower(string_split(path, '/')[-1]), '[^a-z0-9]+', '-', 'g'), '-') as leaf, trim(regexp_replace(lower(regexp_replace(path, '/[^/]*$', '')), '[^a-z0-9]+', '-', 'g'), '-') as parent from (select path from raw union select path from np union select path from pqt)),
tok as (select path, leaf, parent, list_distinct([x for x in string_split(leaf, '-') if length(x) >= 4]) as tokens from norm),
pairs as (
  select layer, raw_path, target_path, target_bytes, m.score as score, m.reason as reason from (
    select 'numpy' as layer, raw.path as raw_path, np.path as target_path, np.bytes as target_bytes from raw, np union all select 'parquet', raw.path, pqt.path, pqt.bytes from raw, pqt) x
  join tok a on a.path = raw_path join tok b on b.path = target_path,
  lateral (select case when raw_path = target_path then {{'score': 100, 'reason': 'exact-path'}} when starts_with(target_path, raw_path || '/') then {{'score': 95, 'reason': 'raw-parent-of-derived'}}
    when starts_with(raw_path, target_path || '/') then {{'score': 85, 'reason': 'derived-parent-of-raw'}} when a.leaf = b.leaf and a.parent = b.parent then {{'score': 90, 'reason': 'same-parent+name'}} when a.leaf = b.leaf then {{'score': 70, 'reason': 'same-name'}}
    when a.parent = b.parent and len(list_intersect(a.tokens, b.tokens)) >= 2 and len(list_intersect(a.tokens, b.tokens)) / (len(a.tokens) + len(b.tokens) - len(list_intersect(a.tokens, b.tokens))) >= 0.75 then {{'score': 60, 'reason': 'same-parent+similar-name'}} else {{'score': 0, 'reason': ''}} end as m)
  where m.score > 0)
"""


@query(f"with {LAYERS} select layer, raw_path, target_path, target_bytes, score, reason from pairs")
def score_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every pair of datasets that matches, without comparing all pairs."""
    raw, numpy, parquet = _layers(spark, sf_dir)
    both = matching.scored(raw, numpy).withColumn("layer", F.lit("numpy")).unionByName(matching.scored(raw, parquet).withColumn("layer", F.lit("parquet")))
    return both.select("layer", "raw_path", "target_path", "target_bytes", "score", "reason")


@query(f"""with {LAYERS}, k as (select *, row_number() over (partition by raw_path order by score desc, len(string_split(target_path, '/')), target_path) as rn, count(*) over (partition by raw_path, score) as ties from pairs where layer = 'parquet')
  select raw_path, case when ties > 1 and reason not in ('exact-path', 'raw-parent-of-derived', 'derived-parent-of-raw') then null else target_path end as path, case when ties > 1 and reason not in ('exact-path', 'raw-parent-of-derived', 'derived-parent-of-raw') then 0 else score end as score,
         case when ties > 1 and reason not in ('exact-path', 'raw-parent-of-derived', 'derived-parent-of-raw') then 'ambiguous' else reason end as reason from k where rn = 1""")
def best_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw, _, parquet = _layers(spark, sf_dir)
    return matching.best(matching.scored(raw, parquet)).select("raw_path", "path", "score", "reason")


@query(f"with {LAYERS} select raw_path, count(*) as n, string_agg(target_path, ';' order by target_path) as paths, sum(target_bytes)::bigint as all_bytes from pairs where layer = 'numpy' and score >= 85 and reason in ('exact-path', 'raw-parent-of-derived', 'derived-parent-of-raw', 'same-parent+name') group by 1")
def structural_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw, numpy, _ = _layers(spark, sf_dir)
    return matching.structural(matching.scored(raw, numpy))


STRUCTURAL = "reason in ('exact-path', 'raw-parent-of-derived', 'derived-parent-of-raw', 'same-parent+name') and score >= 85"
AUDIT = f"""{LAYERS},
k as (select *, row_number() over (partition by layer, raw_path order by score desc, len(string_split(target_path, '/')), target_path) as rn, count(*) over (partition by layer, raw_path, score) as ties from pairs),
b as (select layer, raw_path, target_path, score from k where rn = 1 and not (ties > 1 and reason not in ('exact-path', 'raw-parent-of-derived', 'derived-parent-of-raw'))),
st as (select distinct layer, raw_path from pairs where {STRUCTURAL}),
present as (select layer, raw_path from st union select layer, raw_path from b where score >= 60),
used as (select layer, target_path from pairs where {STRUCTURAL} union select layer, target_path from b),
rows as (
  select path as raw_path, '' as orphan, case when exists (select 1 from present x where x.raw_path = path and layer = 'parquet') then 'parquet-candidate-present' when exists (select 1 from present x where x.raw_path = path and layer = 'numpy') then 'legacy-only' else 'raw-only' end as status from raw
  union all select '', path, 'orphan-numpy' from np where path not in (select target_path from used where layer = 'numpy')
  union all select '', path, 'orphan-parquet' from pqt where path not in (select target_path from used where layer = 'parquet'))
"""


@query(f"with {AUDIT} select raw_path, orphan, status, case status when 'parquet-candidate-present' then 'validate-parquet' when 'legacy-only' then 'convert-raw-to-parquet' when 'raw-only' then 'convert-raw-to-parquet' else 'manual-review' end as action from rows")
def dataset_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = matching.audit(*_layers(spark, sf_dir))
    orphan = F.when(F.col("status") == "orphan-numpy", F.col("numpy_path")).when(F.col("status") == "orphan-parquet", F.col("parquet_path")).otherwise("")
    return rows.select("raw_path", orphan.alias("orphan"), "status", "action")


@query(f"with {AUDIT} select status, count(*) as datasets from rows group by 1")
def audit_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return matching.audit_summary(matching.audit(*_layers(spark, sf_dir))).select("status", "datasets")


@query("""with u as (select page_id, regexp_replace(regexp_replace(url, '^[a-z]+://', ''), '[?#].*$', '') as path from pages),
  a as (select distinct array_to_string(string_split(path, '/')[1:2], '/') as folder from u)
  select page_id, folder from u join a on starts_with(path, folder || '/')""")
def ancestor_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages below each folder: a prefix join as an equality on exploded prefixes."""
    path = F.regexp_replace(F.regexp_replace("url", "^[a-z]+://", ""), "[?#].*$", "")
    u = table(spark, sf_dir, "pages").select("page_id", path.alias("path"))
    folders = u.select(F.array_join(F.slice(F.split("path", "/"), 1, 2), "/").alias("folder")).distinct()
    return u.select("page_id", F.explode(names.ancestors(F.col("path"))).alias("folder")).join(folders, "folder").select("page_id", "folder")


@query("""with f as (select source || '/' || lang as dataset, 'd' || doc_id::varchar || case doc_id % 4 when 0 then '.csv' when 1 then '.CSV.gz' when 2 then '' else '.tar.gz' end as name, strlen(text)::bigint as bytes from documents),
  x as (select dataset, case when lower(name) like '%.tar.gz' then '.tar.gz' when lower(name) like '%.csv.gz' then '.csv.gz' when lower(name) like '%.csv' then '.csv' else '<no-ext>' end as ext, bytes from f),
  n as (select dataset, ext, count(*) as n, sum(bytes) as bytes from x group by 1, 2)
  select dataset, sum(bytes)::bigint as bytes, sum(n)::int as files, string_agg(ext || ':' || n::varchar, ',' order by n desc, ext) as formats from n group by 1""")
def format_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents")
    k = F.col("doc_id") % 4
    suffix = F.when(k == 0, ".csv").when(k == 1, ".CSV.gz").when(k == 2, "").otherwise(".tar.gz")
    path = F.concat(F.lit("x/d"), F.col("doc_id").cast("string"), suffix)
    rows = d.select(F.concat_ws("/", "source", "lang").alias("dataset"), path.alias("path"), F.octet_length("text").cast("long").alias("bytes"))
    return matching.formats(rows, "dataset")


@query("""with f as (select 'k' || (doc_id % 9)::varchar || '/' || source || case when doc_id % 9 < 3 then '/sub' else '' end as folder, case when doc_id = 27 then 'dataset.json' else 'd' || doc_id::varchar || '.parquet' end as name, strlen(text)::bigint as bytes from documents),
  b as (select distinct folder as bound from f where name = 'dataset.json'),
  i as (select f.*, coalesce((select min(bound) from b where folder = bound or starts_with(folder, bound || '/')), folder) as ds from f)
  select ds as relative_path, sum(bytes)::bigint as bytes, count(*)::int as files from i group by 1""")
def leaf_datasets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dataset folders of a layer, from a listing of its files."""
    k = F.col("doc_id") % 9
    folder = F.concat(F.lit("k"), k.cast("string"), F.lit("/"), F.col("source"), F.when(k < 3, "/sub").otherwise(""))
    name = F.when(F.col("doc_id") == 27, "dataset.json").otherwise(F.concat(F.lit("d"), F.col("doc_id").cast("string"), F.lit(".parquet")))
    files = table(spark, sf_dir, "documents").select(F.concat(folder, F.lit("/"), name).alias("path"), F.octet_length("text").cast("long").alias("bytes"))
    return matching.inventory(files, "parquet").select("relative_path", "bytes", "files")


def _moves(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    p = table(spark, sf_dir, "part")
    k = F.col("p_partkey")
    file = F.concat(k.cast("string"), F.lit(".parquet"))
    old = p.select(F.concat(F.lit("transport/baac/"), file).alias("path"), F.col("p_size").cast("long").alias("bytes"), F.col("p_brand").alias("sha256"), F.lit(True).alias("is_file"))
    new = p.filter(k % 3 != 0).select(F.concat(F.lit("transport/accidents/baac/"), file).alias("path"), (F.col("p_size") + (k % 5 == 0).cast("int")).cast("long").alias("bytes"), F.when(k % 4 == 0, "x").otherwise(F.col("p_brand")).alias("sha256"), (k % 7 != 0).alias("is_file"))
    return old, old.unionByName(new)


@query("""select 'transport/baac/' || p_partkey::varchar || '.parquet' as source, 'transport/accidents/baac/' || p_partkey::varchar || '.parquet' as destination, 'normalize-baac' as reason,
  case when p_partkey % 3 = 0 then 'move' when p_partkey % 7 = 0 then 'conflict-destination-not-file' when p_partkey % 5 = 0 then 'conflict-size' when p_partkey % 4 = 0 then 'conflict-sha256' else 'drop-source-duplicate' end as action from part""")
def plan_actions(spark: SparkSession, sf_dir: str) -> DataFrame:
    files, state = _moves(spark, sf_dir)
    return layout.actions(layout.by_prefix(files), state)


@query("""select 'transport/baac/' || p_partkey::varchar || '.parquet' as source, case when p_partkey % 7 = 0 then 'conflict-destination-not-file' when p_partkey % 5 = 0 then 'conflict-size' else 'conflict-sha256' end as action
  from part where p_partkey % 3 <> 0 and (p_partkey % 7 = 0 or p_partkey % 5 = 0 or p_partkey % 4 = 0) order by 1 limit 20""")
def first_conflicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    files, state = _moves(spark, sf_dir)
    return layout.first_conflicts(layout.actions(layout.by_prefix(files), state)).select("source", "action")


@query("""with f as (select 'in/rna_' || case doc_id % 3 when 0 then 'import' when 1 then 'waldec' else 'other' end || '_20' || lpad((doc_id % 30)::varchar, 2, '0') || '0' || (doc_id % 9 + 1)::varchar || '15_' || doc_id::varchar || '.parquet' as path, doc_id from documents)
  select path as source, regexp_extract(path, '^in/rna_(import|waldec)_', 1) || '/' || substr(regexp_extract(path, '_(20[0-9]{6})_', 1), 1, 4) || '-' || substr(regexp_extract(path, '_(20[0-9]{6})_', 1), 5, 2) || '-15/' || string_split(path, '/')[-1] as destination,
         regexp_extract(path, '^in/rna_(import|waldec)_', 1) as kind, substr(regexp_extract(path, '_(20[0-9]{6})_', 1), 1, 4) || '-' || substr(regexp_extract(path, '_(20[0-9]{6})_', 1), 5, 2) || '-15' as date from f where doc_id % 3 <> 2""")
def dated_layout(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = F.col("doc_id")
    kind = F.when(i % 3 == 0, "import").when(i % 3 == 1, "waldec").otherwise("other")
    path = F.concat(F.lit("in/rna_"), kind, F.lit("_20"), F.lpad((i % 30).cast("string"), 2, "0"), F.lit("0"), (i % 9 + 1).cast("string"), F.lit("15_"), i.cast("string"), F.lit(".parquet"))
    return layout.by_dated_name(table(spark, sf_dir, "documents").select(path.alias("path")))


@query("""with f as (select 'geojson/' || case doc_id % 3 when 0 then 'carte-des-zones-et-arr-t-s-en-vigueur-geojson-20' || (10 + doc_id % 15)::varchar when 1 then 'cartes-des-zones-et-arr-t-s-en-vigueur-geojson-20' || (10 + doc_id % 15)::varchar else 'other' end || '/a/' || doc_id::varchar || '.parquet' as path, doc_id from documents)
  select path as source, 'geojson/20' || (10 + doc_id % 15)::varchar || '/a/' || doc_id::varchar || '.parquet' as destination, '20' || (10 + doc_id % 15)::varchar as year from f where doc_id % 3 <> 2""")
def year_layout(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = F.col("doc_id")
    year = F.concat(F.lit("20"), (10 + i % 15).cast("string"))
    folder = F.when(i % 3 == 0, F.concat(F.lit("carte-des-zones-et-arr-t-s-en-vigueur-geojson-"), year)).when(i % 3 == 1, F.concat(F.lit("cartes-des-zones-et-arr-t-s-en-vigueur-geojson-"), year)).otherwise("other")
    return layout.by_year_folder(table(spark, sf_dir, "documents").select(F.concat(F.lit("geojson/"), folder, F.lit("/a/"), i.cast("string"), F.lit(".parquet")).alias("path")))


@query("""with f as (select page_id::varchar as path, coalesce(nullif(trim(regexp_replace(lower(regexp_replace(url, '^[a-z]+://([^/]*).*$', '\\1')), '[^a-z0-9]+', '-', 'g'), '-'), ''), 'dataset') as output from pages)
  select output, count(*) as sources, string_agg(path, ';' order by path) as paths from f group by 1 having count(*) > 1""")
def collision_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    host = F.regexp_replace("url", "^[a-z]+://([^/]*).*$", "$1")
    return layout.collisions(table(spark, sf_dir, "pages").select(F.col("page_id").cast("string").alias("path"), names.slug(host).alias("output")))


@query("with n as (select n_regionkey, n_nationkey, s_suppkey from supplier join nation on s_nationkey = n_nationkey) select r_name as department, count(*) as files, sum(s_suppkey)::bigint as bytes from n join region on n_regionkey = r_regionkey group by rollup(r_name)")
def dept_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = table(spark, sf_dir, "supplier").join(table(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey")).join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    return s.rollup(F.col("r_name").alias("department")).agg(F.count("*").alias("files"), F.sum("s_suppkey").alias("bytes"))
