"""Decoders and scalar functions: values are rendered in the plan, decoded, and compared with SQL on the originals."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestack.functions import copytext, dates, ewkb, jsontext, names, ntriples, pgarray, pgtypes, sniff
from lodestack.operators.ranking import ranked
from lodestack.plans import commit
from lodestack.queries.common import LOG, events_log, table
from lodestack.registry import query
from lodestack.sources import pgdump
from lodestack.streaming import status

SLUG = "coalesce(nullif(trim(regexp_replace(lower({0}), '[^a-z0-9]+', '-', 'g'), '-'), ''), 'dataset')"


@query(f"select page_id, {SLUG.format('url')} as slug, {SLUG.format('url')} || '-' || substr(sha256(url), 1, 10) as stable_name from pages")
def slug_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", names.slug(F.col("url")).alias("slug"), names.stable_name(F.col("url")).alias("stable_name"))


@query("select doc_id, trim(regexp_replace(lower(strip_accents(text)), '[^a-z0-9]+', '-', 'g'), '-') as name from documents")
def normalized_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole texts as names: without accents, other characters as dashes."""
    return table(spark, sf_dir, "documents").select("doc_id", names.normalized(F.col("text")).alias("name"))


PATH = "regexp_replace(regexp_replace(url, '^[a-z]+://', ''), '[?#].*$', '')"


@query(f"""with p as (select page_id, {PATH} as path from pages)
  select page_id, string_split(path, '/')[1] as domain, case when contains(path, '/') then regexp_replace(path, '/[^/]*$', '') else '.' end as parent, len([x for x in string_split(path, '/') if x <> '']) as depth, string_split(path, '/')[-1] as leaf from p""")
def path_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = F.regexp_replace(F.regexp_replace("url", "^[a-z]+://", ""), "[?#].*$", "")
    p = table(spark, sf_dir, "pages").select("page_id", path.alias("path"))
    c = F.col("path")
    return p.select("page_id", names.top_domain(c).alias("domain"), names.parent(c).alias("parent"), names.depth(c).alias("depth"), names.leaf(c).alias("leaf"))


@query("""with f as (select o_orderkey, 'a/x_' || case o_orderkey % 4 when 0 then '20' || strftime(o_orderdate, '%y-%m-%d') when 1 then '20' || strftime(o_orderdate, '%y_%m_%d') when 2 then '20' || strftime(o_orderdate, '%y%m%d') else strftime(o_orderdate, '%Y') end || '_v.csv' as path from orders),
  x as (select o_orderkey, regexp_extract(path, '(?:^|[^0-9])(20[0-9][0-9])[-_]([0-9][0-9])[-_]([0-9][0-9])(?:[^0-9]|$)', ['y', 'm', 'd']) as a, regexp_extract(path, '(?:^|[^0-9])(20[0-9][0-9])([0-9][0-9])([0-9][0-9])(?:[^0-9]|$)', ['y', 'm', 'd']) as b from f)
  select o_orderkey, case when a.y <> '' then a.y || '-' || a.m || '-' || a.d when b.y <> '' then b.y || '-' || b.m || '-' || b.d else '' end as snapshot_date from x""")
def extract_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("o_orderkey") % 4
    date = F.col("o_orderdate")
    text = F.when(k == 0, F.concat(F.lit("20"), F.date_format(date, "yy-MM-dd"))).when(k == 1, F.concat(F.lit("20"), F.date_format(date, "yy_MM_dd"))).when(k == 2, F.concat(F.lit("20"), F.date_format(date, "yyMMdd"))).otherwise(F.date_format(date, "yyyy"))
    return table(spark, sf_dir, "orders").select("o_orderkey", dates.extract(F.concat(F.lit("a/x_"), text, F.lit("_v.csv"))).alias("snapshot_date"))


@query("select o_orderkey, strftime(o_orderdate, '%Y-%m-%d') as day, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') as moment from orders")
def iso_normalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dates rendered with slashes and dots come back."""
    slash, dot = F.date_format("o_orderdate", "yyyy/MM/dd"), F.date_format("o_orderdate", "yyyy.MM.dd HH:mm:ss")
    day, moment = pgtypes.decode(slash, "date"), pgtypes.decode(dot, "timestamp")
    return table(spark, sf_dir, "orders").select("o_orderkey", F.date_format(day, "yyyy-MM-dd").alias("day"), F.date_format(moment, "yyyy-MM-dd HH:mm:ss").alias("moment"))


@query("select o_orderkey, strftime(date_trunc('day', o_orderdate) + interval 1 day, '%Y-%m-%d %H:%M:%S') as moment from orders")
def leap_second(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Second 60 of a day's last minute is the next midnight."""
    text = F.concat(F.date_format("o_orderdate", "yyyy/MM/dd"), F.lit("T23:59:60"))
    return table(spark, sf_dir, "orders").select("o_orderkey", F.date_format(pgtypes.decode(text, "timestamp"), "yyyy-MM-dd HH:mm:ss").alias("moment"))


@query("select event_id, user_id, event_type, props, value from events")
def copy_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events written as COPY lines (with tabs and line ends put into a value), split, unescaped and typed."""
    e = table(spark, sf_dir, "events")
    odd = F.concat("props", F.lit("\t\\\n"), F.col("event_type"))
    line = F.concat_ws("\t", *[copytext.escape(c) for c in (F.col("event_id").cast("string"), F.col("user_id").cast("string"), F.col("event_type"), odd, F.col("value").cast("string"))])
    entry = {"schema": "s", "table": "events", "columns": ["event_id", "user_id", "event_type", "odd", "value"], "geometries": {}, "pg_types": {"event_id": "int8", "user_id": "bigint", "event_type": "varchar(20)", "odd": "text", "value": "double precision"}}
    out = pgdump.typed(e.select(line.alias("line")), entry)
    return out.select("event_id", "user_id", "event_type", F.substring("odd", F.lit(1), F.length("odd") - 3 - F.length("event_type")).alias("props"), "value")


@query("with t as (select doc_id, text as v from documents) select doc_id, v as a, case when doc_id % 3 = 0 then null else v end as b, 3 as n from t")
def copy_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text and nulls through COPY fields."""
    d = table(spark, sf_dir, "documents").select("doc_id", F.col("text").alias("v"))
    line = F.concat_ws("\t", copytext.escape(F.col("doc_id").cast("string")), copytext.escape(F.col("v")), copytext.escape(F.when(F.col("doc_id") % 3 != 0, F.col("v"))))
    row = d.select(copytext.parse_row(line).alias("f"))
    return row.select(F.col("f")[0].cast("long").alias("doc_id"), F.col("f")[1].alias("a"), F.col("f")[2].alias("b"), F.size("f").alias("n"))


@query("select l_orderkey, string_agg(l_linenumber::varchar, ',' order by l_linenumber) as numbers, string_agg(l_returnflag || '\"' || l_linestatus, ';' order by l_linenumber, l_returnflag, l_linestatus) as flags, count(*) as n from lineitem group by 1")
def pg_array_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Arrays rendered as literals, parsed and typed again."""
    lines = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.sort_array(F.collect_list(F.struct("l_linenumber", "l_returnflag", "l_linestatus"))).alias("x"))
    numbers = pgarray.render(F.transform("x", lambda v: v["l_linenumber"].cast("string")))
    flags = pgarray.render(F.transform("x", lambda v: F.concat(v["l_returnflag"], F.lit('"'), v["l_linestatus"])))
    back = lines.select("l_orderkey", pgtypes.decode(numbers, "int4[]").alias("numbers"), pgtypes.decode(flags, "text[]").alias("flags"))
    return back.select("l_orderkey", F.array_join(F.transform("numbers", lambda v: v.cast("string")), ",").alias("numbers"), F.array_join("flags", ";").alias("flags"), F.size("numbers").cast("long").alias("n"))


@query("select o_orderkey, o_totalprice::decimal(17, 3)::varchar as price, (o_custkey % 1000)::smallint as small, o_orderdate::date::varchar as day, o_totalprice > 150000 as high, o_totalprice as plain from orders")
def typed_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text values of declared types."""
    o = table(spark, sf_dir, "orders")
    price = F.col("o_totalprice").cast("decimal(17,3)").cast("string")
    return o.select(
        "o_orderkey", pgtypes.decode(price, "numeric(17, 3)").cast("string").alias("price"), pgtypes.decode((F.col("o_custkey") % 1000).cast("string"), "int2").alias("small"),
        pgtypes.decode(F.date_format("o_orderdate", "yyyy/MM/dd"), "date").cast("string").alias("day"), pgtypes.decode(F.when(F.col("o_totalprice") > 150000, "t").otherwise("False"), "boolean").alias("high"),
        pgtypes.decode(F.col("o_totalprice").cast("string"), "double precision").alias("plain"),
    )


@query("""select vec_id, case when vec_id % 3 = 0 then '0101000000' || lpad(lower(hex(vec_id)), 16, '0') || repeat('40', 8) when vec_id % 3 = 1 then '0000000001' || repeat('3f', 8) || lpad(lower(hex(vec_id)), 16, '0') else '0103000000' || lpad(lower(hex(vec_id)), 8, '0') end as wkb from embeddings""")
def ewkb_to_wkb(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Payloads in both byte orders with an SRID, and one without."""
    k = F.lower(F.lpad(F.hex("vec_id"), 16, "0"))
    text = F.when(F.col("vec_id") % 3 == 0, F.concat(F.lit("01010000206a080000"), k, F.lit("40" * 8))).when(F.col("vec_id") % 3 == 1, F.concat(F.lit("00200000010000086A"), F.lit("3f" * 8), k)).otherwise(F.concat(F.lit("\\x0103000000"), F.substring(k, 9, 8)))
    return table(spark, sf_dir, "embeddings").select("vec_id", F.lower(F.hex(ewkb.to_wkb(text))).alias("wkb"))


@query("""select '<' || split_part(url, '#', 1) || '>' as subject, '<p' || (page_id % 5)::varchar || '>' as predicate,
  case page_id % 4 when 0 then '<http://o/' || page_id::varchar || '>' when 1 then '_:b' || page_id::varchar when 2 then '"a b . c"@fr' else page_id::varchar end as object,
  case page_id % 4 when 0 then 'iri' when 1 then 'bnode' when 2 then 'literal' else 'other' end as object_kind from pages""")
def ntriples_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages written as N-Triples lines, with blank lines between, and parsed."""
    k, i = F.col("page_id") % 4, F.col("page_id").cast("string")
    obj = F.when(k == 0, F.concat(F.lit("<http://o/"), i, F.lit(">"))).when(k == 1, F.concat(F.lit("_:b"), i)).when(k == 2, F.lit('"a b . c"@fr')).otherwise(i)
    line = F.concat(F.lit("<"), F.substring_index("url", "#", 1), F.lit("> <p"), (F.col("page_id") % 5).cast("string"), F.lit("> "), obj, F.lit(" ."))
    lines = table(spark, sf_dir, "pages").select(F.explode(F.array(line, F.lit(" "))).alias("value"))
    return ntriples.triples(lines)


@query("""select event_id, m.key as key, m.kind as kind, m.item_index as item_index, m.json as json from events,
  lateral (select unnest([{'key': 'k', 'kind': 'scalar', 'item_index': null::bigint, 'json': json_extract(props, '$.k')::varchar}, {'key': 'a', 'kind': 'array-item', 'item_index': 0::bigint, 'json': user_id::varchar}, {'key': 'a', 'kind': 'array-item', 'item_index': 1::bigint, 'json': '"' || event_type || '"'},
    {'key': 'e', 'kind': 'empty-array', 'item_index': null::bigint, 'json': '[]'}, {'key': 'o', 'kind': 'object', 'item_index': null::bigint, 'json': '{"z":1,"b":null}'}]) as m)""")
def json_lossless(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Members of JSON objects as text, in order, with their kinds."""
    e = table(spark, sf_dir, "events")
    text = F.concat(F.expr("substring(props, 1, length(props) - 1)"), F.lit(', "a": ['), F.col("user_id").cast("string"), F.lit(', "'), "event_type", F.lit('"], "e": [], "o": {"z": 1, "b": null}}'))
    return jsontext.members(e.select("event_id", text.alias("value")), "value", "event_id")


@query("select user_id, i as item_index, event_id as value from (select user_id, event_id, row_number() over (partition by user_id order by event_id) - 1 as i from events)")
def json_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items of JSON arrays with their index."""
    arrays = table(spark, sf_dir, "events").groupBy("user_id").agg(F.to_json(F.sort_array(F.collect_list("event_id"))).alias("value"))
    rows = arrays.select("user_id", F.posexplode(jsontext.items(F.col("value"))).alias("i", "json"))
    return rows.select("user_id", F.col("i").cast("long").alias("item_index"), F.col("json").cast("long").alias("value"))


@query("""with t as (select doc_id, string_split(text, chr(10)) as x from documents where text <> ''), l as (select doc_id, unnest(x) as line, generate_subscripts(x, 1) as line_number, len(x) as n from t)
  select doc_id, line_number::bigint as line_number, case when line_number < n then line || chr(10) else line end as text from l where line_number < n or line <> ''""")
def text_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Physical lines of documents with their ends."""
    lines = table(spark, sf_dir, "documents").select("doc_id", F.posexplode(jsontext.lines(F.col("text"))).alias("i", "text"))
    return lines.select("doc_id", (F.col("i") + 1).cast("long").alias("line_number"), "text")


@query("select event_id, case event_id % 5 when 0 then null when 1 then null when 2 then null when 3 then 'Null' else event_type end as cell from events")
def null_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("event_id") % 5
    cell = F.when(k == 0, "").when(k == 1, "null").when(k == 2, "NULL").when(k == 3, "Null").otherwise(F.col("event_type"))
    return table(spark, sf_dir, "events").select("event_id", jsontext.null_token(cell).alias("cell"))


@query("""select page_id, case page_id % 7 when 0 then 'parquet' when 1 then 'text/xml' when 2 then 'json' when 3 then 'zip' when 4 then 'spreadsheetml' when 5 then 'sqlite' else 'unknown' end as magic,
  case page_id % 5 when 0 then 'csv.gz' when 1 then 'geojson' when 2 then 'non-tabular' when 3 then 'xlsx' else null end as suffix from pages""")
def magic_kind(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Kinds by first bytes and by suffix."""
    k, s = F.col("page_id") % 7, F.col("page_id") % 5
    html = F.col("html")
    text = F.when(k == 0, F.concat(F.lit("PAR1"), html)).when(k == 1, F.concat(F.lit(" \n"), html)).when(k == 2, F.lit('\n{"a": 1}')).when(k == 3, F.lit("PK\x03\x04rest")).when(k == 4, F.concat(F.lit("<?xml version='1.0'?><Workbook>"), html)).when(k == 5, F.lit("SQLite format 3\x00")).otherwise("plain")
    name = F.concat(F.lit("a/b.c"), F.when(s == 0, ".CSV.gz").when(s == 1, ".geojson").when(s == 2, ".PDF").when(s == 3, ".xlsx").otherwise(".bin"))
    return table(spark, sf_dir, "pages").select("page_id", sniff.by_magic(text.cast("binary")).alias("magic"), sniff.by_suffix(name).alias("suffix"))


@query("select doc_id, floor((row_number() over (order by doc_id) - 1) / 250)::bigint as part from documents")
def part_assignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Part of each row when parts hold exactly 250 rows in order: ranks from counts of at most 100,000 id ranges."""
    return ranked(table(spark, sf_dir, "documents"), "doc_id").select("doc_id", commit.part_number(F.col("rank"), 250).alias("part"))


@query("select event_type, printf('%.6f', sum(event_id) / 1073741824.0) as gib, printf('%.3f', sum(event_id) / 1048576.0) as mib from events group by 1")
def size_units(spark: SparkSession, sf_dir: str) -> DataFrame:
    sums = table(spark, sf_dir, "events").groupBy("event_type").agg(F.sum("event_id").alias("b"))
    return sums.select("event_type", names.gib(F.col("b"), 6).alias("gib"), names.mib(F.col("b")).alias("mib"))


@query("""with t as (select page_id, list_distinct([x for x in string_split(lower(regexp_replace(regexp_replace(url, '^[a-z]+://', ''), '[^A-Za-z0-9]+', '-', 'g')), '-') if length(x) >= 4]) as w from pages)
  select a.page_id as left_page, b.page_id as right_page, len(list_intersect(a.w, b.w)) as common from t a join t b on a.page_id < b.page_id where len(list_intersect(a.w, b.w)) >= 2 and len(list_intersect(a.w, b.w)) / (len(a.w) + len(b.w) - len(list_intersect(a.w, b.w))) >= 0.75""")
def token_overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of page names that share at least two long tokens and three quarters of them all.

    Sets are classes first, so equal names aren't paired by their tokens; of each pair of sets the
    rarest tokens lead (a pair that is alike must share one of its leading tokens).
    """
    url = F.lower(F.regexp_replace(F.regexp_replace("url", "^[a-z]+://", ""), "[^A-Za-z0-9]+", "-"))
    words = F.sort_array(F.array_distinct(F.filter(F.split(url, "-"), lambda t: F.length(t) >= 4)))
    rows = table(spark, sf_dir, "pages").select("page_id", words.alias("w"))
    sets = rows.select("w").distinct()
    rank = sets.select(F.explode("w").alias("t")).groupBy("t").agg(F.count("*").alias("sets"))
    ranked = sets.select("w", F.explode("w").alias("t")).join(rank, "t").groupBy("w").agg(F.transform(F.sort_array(F.collect_list(F.struct("sets", "t"))), lambda x: x["t"]).alias("rare"))
    n = F.size("w")
    led = ranked.select("w", F.explode(F.slice("rare", F.lit(1), n - F.ceil(n * 0.75).cast("int") + 1)).alias("t"))
    a, b = led.select(F.col("w").alias("a"), "t"), led.select(F.col("w").alias("b"), "t")
    found = a.join(b, "t").filter("a <= b").select("a", "b").distinct()
    common = F.size(F.array_intersect("a", "b"))
    alike = found.filter((common >= 2) & (common / (F.size("a") + F.size("b") - common) >= 0.75)).withColumn("common", common)
    left, right = rows.select(F.col("page_id").alias("x"), F.col("w").alias("a")), rows.select(F.col("page_id").alias("y"), F.col("w").alias("b"))
    pairs = alike.join(left, "a").join(right, "b").filter((F.col("a") != F.col("b")) | (F.col("x") < F.col("y")))
    return pairs.select(F.least("x", "y").alias("left_page"), F.greatest("x", "y").alias("right_page"), "common")


@query(f"with {LOG} select source, status, kind from l")
def streaming_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Latest status of each source by a stream over the table's files, run to the end of what is there."""
    import tempfile
    import uuid

    root = spark.conf.get("spark.checkpoint.dir", None) or "file://" + tempfile.mkdtemp(prefix="lodestack-")
    base = f"{root.rstrip('/')}/lodestack-stream-{uuid.uuid4().hex}"
    log = events_log(spark, sf_dir).select("source", "status", "kind", "log", "at")
    log.write.parquet(f"{base}/landing")
    stream = spark.readStream.schema(log.schema).parquet(f"{base}/landing")
    status.run_latest(stream, "source", ["log", "at"], ["status", "kind"], f"{base}/out", f"{base}/state").awaitTermination()
    return status.read_latest(spark, f"{base}/out", "source")


@query("select event_type as status, count(*) as records, count(*) filter (value > 50) as large, max(event_id) as last_record from events group by 1")
def status_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Histogram of a log with conditional counts."""
    return table(spark, sf_dir, "events").groupBy(F.col("event_type").alias("status")).agg(F.count("*").alias("records"), F.count_if(F.col("value") > 50).alias("large"), F.max("event_id").alias("last_record"))


@query("select 'documents' as name, count(*) as rows, sum(strlen(text))::bigint as bytes from documents union all select 'pages', count(*), sum(strlen(html))::bigint from pages")
def manifest_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Union of the records of two sources."""
    def one(name: str, column: str) -> DataFrame:
        return table(spark, sf_dir, name).agg(F.count("*").alias("rows"), F.sum(F.octet_length(column).cast("long")).alias("bytes")).select(F.lit(name).alias("name"), "rows", "bytes")

    return one("documents", "text").unionByName(one("pages", "html"))

