"""Readers and writers: tables are written out as files of a format, read back, and compared with SQL on the tables."""

from __future__ import annotations

import io
import zipfile
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestack.functions import copytext, sniff
from lodestack.operators import reconcile, release, semantic
from lodestack.plans import commit, convert, migrate, snapshots
from lodestack.queries.common import CLASS, ENTRIES, LOG, entries, events_log, local, one_file, scratch, table
from lodestack.registry import query
from lodestack.sources import archives, catalogs, delimited, files, footers, geo, jsonfiles, pgdump, plain, sheets

EVENTS = {"event_id": "bigint", "user_id": "bigint", "event_type": "character varying(20)", "props": "text", "value": "double precision"}
CUSTOMERS = {"c_custkey": "bigint", "c_name": "text", "c_nationkey": "integer", "c_mktsegment": "text"}


def _dump(spark: SparkSession, sf_dir: str, gzipped: bool = False) -> str:
    """A dump with events and customers: DDL, a geometry column that has no rows here, and two COPY blocks."""
    base = scratch(spark, "dump")

    def block(name: str, types: dict[str, str]) -> tuple[str, DataFrame]:
        ddl = "".join(f'ALTER TABLE "s"."{name}" ADD COLUMN "{c}" {t};\n' for c, t in types.items())
        values = [copytext.escape(F.col(c).cast("string")) for c in types]
        names = ", ".join(f'"{c}"' for c in types)
        return f'SET x;\n{ddl}\nCOPY "s"."{name}" ({names}) FROM STDIN;\n', table(spark, sf_dir, name if name == "events" else "customer").select(F.concat_ws("\t", *values).alias("value"))

    events, rows = block("events", EVENTS)
    first = one_file(rows, f"{base}/events.sql", events, "\\.\n\n")
    customers, rows = block("customers", CUSTOMERS)
    second = one_file(rows, f"{base}/customers.sql", customers, "\\.\n")
    import gzip
    import shutil

    path = f"{base}/dump.sql" + (".gz" if gzipped else "")
    with (gzip.open if gzipped else open)(local(path), "wb") as out:
        for part in (first, second):
            with open(local(part), "rb") as f:
                shutil.copyfileobj(f, out)
    return local(path)


@query("select event_id, user_id, event_type, props, value from events")
def dump_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events out of a plain dump of two tables, by its catalog's byte ranges, typed by its DDL."""
    path = _dump(spark, sf_dir)
    pgdump.save_catalog(pgdump.build_catalog(path, split=64 << 10), path + ".json")
    return pgdump.read_table(spark, path, "s.events", path + ".json")


@query("select c_custkey, c_name, c_nationkey::int as c_nationkey, c_mktsegment from customer")
def dump_gzip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The second table of a gzipped dump."""
    return pgdump.read_table(spark, _dump(spark, sf_dir, gzipped=True), "customers")


@query("select 'events' as \"table\", count(*) as rows, 5 as columns, sum(event_id)::bigint as keys, 'skipped' as again from events union all select 'customers', count(*), 4, sum(c_custkey)::bigint, 'skipped' from customer")
def dump_convert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A dump converted to committed tables; a second conversion skips what is done. Rows and columns by the markers, keys from the data."""
    path = _dump(spark, sf_dir)
    out = local(scratch(spark, "converted"))
    convert.convert(spark, path, out)
    again = spark.createDataFrame([(r["table"], r["state"]) for r in convert.convert(spark, path, out)], "`table` string, again string")
    keys = spark.read.parquet(f"{out}/s/events").select(F.lit("events").alias("table"), F.col("event_id").alias("k")).unionByName(spark.read.parquet(f"{out}/s/customers").select(F.lit("customers").alias("table"), F.col("c_custkey").alias("k")))
    sums = keys.groupBy("table").agg(F.sum("k").alias("keys"))
    return convert.table_manifest(spark, out).join(sums, "table").join(again, "table").select("table", "rows", "columns", "keys", "again")


def _csv(columns: list[Column], sep: str = ",") -> Column:
    return F.concat_ws(sep, *[F.concat(F.lit('"'), F.replace(c.cast("string"), F.lit('"'), F.lit('""')), F.lit('"')) for c in columns])


@query("select doc_id::varchar as doc_id, nullif(text, '') as text, lang, case when doc_id % 3 = 0 then null else source end as source from documents")
def csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole texts, with line ends and quotes, through a CSV file of strings; null tokens come back as null."""
    d = table(spark, sf_dir, "documents")
    source = F.when(F.col("doc_id") % 3 == 0, F.when(F.col("doc_id") % 2 == 0, "NULL").otherwise("null")).otherwise(F.col("source"))
    lines = d.select(_csv([F.col("doc_id"), F.col("text"), F.col("lang"), source]).alias("value"))
    return delimited.read_strings(spark, one_file(lines, f"{scratch(spark, 'csv')}/d.csv", "doc_id,text,lang,source\n"), ",")


@query("select count(*) as n, sum(l_orderkey)::bigint as keys, round(sum(l_extendedprice), 2) as price, count(distinct l_returnflag) as flags from lineitem")
def csv_inferred(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Types found in a semicolon-separated file let its columns be summed."""
    rows = table(spark, sf_dir, "lineitem").select(_csv([F.col("l_orderkey"), F.col("l_extendedprice"), F.col("l_returnflag")], ";").alias("value"))
    path = one_file(rows, f"{scratch(spark, 'csv')}/l.csv", "l_orderkey;l_extendedprice;l_returnflag\n")
    return delimited.read_inferred(spark, path).agg(F.count("*").alias("n"), F.sum("l_orderkey").cast("long").alias("keys"), F.round(F.sum("l_extendedprice"), 2).alias("price"), F.count_distinct("l_returnflag").alias("flags"))


@query("""select '["' || o_orderkey::varchar || '"' || case when o_orderkey % 3 = 0 then ',"' || o_orderpriority || '"' else '' end || case when o_orderkey % 6 = 0 then ',"a \\"b\\""' else '' end || ']' as row_json, 'lossless-csv-row-json' as kind from orders union all select '["key","priority"]', 'lossless-csv-row-json'""")
def csv_ragged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of one to three cells: no header fits them, so each comes as a JSON array."""
    k = F.col("o_orderkey")
    line = F.concat(k.cast("string"), F.when(k % 3 == 0, F.concat(F.lit(","), "o_orderpriority")).otherwise(""), F.when(k % 6 == 0, ',"a ""b"""').otherwise(""))
    rows, kind = delimited.read_any(spark, one_file(table(spark, sf_dir, "orders").select(line.alias("value")), f"{scratch(spark, 'csv')}/o.csv", "key,priority\n"))
    return rows.select("row_json", F.lit(kind).alias("kind"))


@query("select event_id, user_id, event_type, 'array' as layout from events")
def json_array_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events in one JSON array over many lines."""
    rows = table(spark, sf_dir, "events").select(F.concat(F.lit(",\n"), F.to_json(F.struct("event_id", "user_id", "event_type"))).alias("value"))
    path = one_file(rows, f"{scratch(spark, 'json')}/e.json", '[ {"event_id": -1}', "]\n")
    found = F.from_json("json", "event_id long, user_id long, event_type string")
    return jsonfiles.read_array(spark, path).select(found.alias("v")).filter("v.event_id >= 0").select("v.*", F.lit(jsonfiles.layout(local(path))).alias("layout"))


@query("select 'k' || user_id::varchar as key, 'array-item' as kind, i as item_index, event_id as value from (select user_id, event_id, row_number() over (partition by user_id order by event_id) - 1 as i from events)")
def json_object_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events by user as members of one JSON object."""
    each = table(spark, sf_dir, "events").groupBy("user_id").agg(F.to_json(F.sort_array(F.collect_list("event_id"))).alias("a"))
    rows = each.select(F.concat(F.lit(',\n"k'), F.col("user_id").cast("string"), F.lit('": '), "a").alias("value"))
    path = one_file(rows, f"{scratch(spark, 'json')}/o.json", '{"first": 1', "}\n")
    return jsonfiles.read_object(spark, path).filter("key <> 'first'").select("key", "kind", F.col("item_index").cast("long").alias("item_index"), F.col("json").cast("long").alias("value"))


@query("select event_id, props, value from events")
def json_lines_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as JSON lines, with blank lines between."""
    line = F.to_json(F.struct("event_id", "props", "value"))
    path = one_file(table(spark, sf_dir, "events").select(F.explode(F.array(line, F.lit(" "))).alias("value")), f"{scratch(spark, 'json')}/e.jsonl")
    return jsonfiles.read_lines(spark, path).select(F.from_json("json", "event_id long, props string, value double").alias("v")).select("v.*")


@query("select c_custkey as id, '0101000000' as head, c_nationkey::double as x, c_custkey::double as y, c_name as name from customer")
def geojson_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as points of a feature collection: attributes, and coordinates out of the WKB."""
    c = table(spark, sf_dir, "customer")
    feature = F.struct(F.lit("Feature").alias("type"), F.struct(F.lit("Point").alias("type"), F.array(F.col("c_nationkey").cast("double"), F.col("c_custkey").cast("double")).alias("coordinates")).alias("geometry"), F.struct("c_custkey", "c_name").alias("properties"))
    rows = c.select(F.concat(F.lit(",\n"), F.to_json(feature)).alias("value"))
    path = one_file(rows, f"{scratch(spark, 'geo')}/c.geojson", '{"type": "FeatureCollection", "features": [{"type": "Feature", "geometry": null, "properties": {}}', "]}\n")
    got = geo.read_geojson(spark, local(path)).filter("geometry is not null")
    p, wkb = F.from_json("properties_json", "c_custkey long, c_name string"), F.lower(F.hex("geometry"))

    def number(at: int) -> Column:
        """A whole number of up to 2^31 from the little-endian double at a byte."""
        bits = F.conv(F.array_join(F.transform(F.sequence(F.lit(7), F.lit(0), F.lit(-1)), lambda i: F.substring(wkb, (2 * at + 1 + 2 * i).cast("int"), F.lit(2))), ""), 16, 10).cast("decimal(20,0)").cast("long")
        exponent = F.shiftright(bits, 52) - 1023
        value = (bits.bitwiseAND(F.lit((1 << 52) - 1)) + F.lit(1 << 52)).cast("double") * F.pow(F.lit(2.0), (exponent - 52).cast("double"))
        return F.when(bits == 0, F.lit(0.0)).otherwise(value)

    return got.select(p["c_custkey"].alias("id"), F.substring(wkb, 1, 10).alias("head"), number(5).alias("x"), number(13).alias("y"), p["c_name"].alias("name"))


@query("select '<http://s/' || event_id::varchar || '>' as subject, '<p' || (event_id % 4)::varchar || '>' as predicate, '\"' || event_type || '\"' as object, 'literal' as object_kind from events")
def triples_zip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as N-Triples in a zip, converted to a committed dataset."""
    i = F.col("event_id").cast("string")
    line = F.concat(F.lit("<http://s/"), i, F.lit("> <p"), (F.col("event_id") % 4).cast("string"), F.lit('> "'), "event_type", F.lit('" .'))
    base = scratch(spark, "nt")
    text = one_file(table(spark, sf_dir, "events").select(line.alias("value")), f"{base}/e.nt")
    with zipfile.ZipFile(local(f"{base}/Events 1.nt.zip"), "w", zipfile.ZIP_DEFLATED) as z:
        z.write(local(text), "e.nt")
    done = snapshots.convert_triples(spark, local(f"{base}/Events 1.nt.zip"), local(f"{base}/out"))
    return spark.read.parquet(local(f"{base}/out/{done['name']}"))


def _xlsx(rows: list[tuple], sheet: str) -> bytes:
    """A workbook of one sheet: numbers as numbers, text as shared strings; null cells are left out."""
    from xml.sax.saxutils import escape

    shared: dict[str, int] = {}
    lines = []
    for r, row in enumerate(rows, 1):
        cells = "".join(f'<c r="{chr(65 + k)}{r}"><v>{v}</v></c>' if isinstance(v, int) else f'<c r="{chr(65 + k)}{r}" t="s"><v>{shared.setdefault(v, len(shared))}</v></c>' for k, v in enumerate(row) if v is not None)
        lines.append(f'<row r="{r}">{cells}</row>')
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("[Content_Types].xml", "<Types/>")
        z.writestr("xl/workbook.xml", f'<workbook xmlns:r="r"><sheets><sheet name="{escape(sheet)}" r:id="r1"/></sheets></workbook>')
        z.writestr("xl/_rels/workbook.xml.rels", '<Relationships><Relationship Id="r1" Target="worksheets/sheet1.xml"/></Relationships>')
        z.writestr("xl/sharedStrings.xml", "<sst>" + "".join(f"<si><t>{escape(s)}</t></si>" for s in shared) + "</sst>")
        z.writestr("xl/worksheets/sheet1.xml", f"<worksheet><sheetData>{''.join(lines)}</sheetData></worksheet>")
    return out.getvalue()


@query("select 'supplier' as sheet, row_number() over (order by s_suppkey) as row_number, '[\"' || s_suppkey::varchar || '\",\"' || s_name || '\",' || case when s_suppkey % 2 = 0 then 'null,' else '\"x\",' end || '\"' || s_nationkey::varchar || '\"]' as row_json from supplier")
def xlsx_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers in a workbook with empty cells, read as text by row."""
    base = scratch(spark, "xlsx")
    rows = [(r["s_suppkey"], r["s_name"], None if r["s_suppkey"] % 2 == 0 else "x", r["s_nationkey"]) for r in table(spark, sf_dir, "supplier").orderBy("s_suppkey").toLocalIterator()]  # a workbook has at most 1,048,576 rows
    Path(local(base)).mkdir(parents=True)
    Path(local(base), "s.xlsx").write_bytes(_xlsx(rows, "supplier"))
    return sheets.read_sheets(spark, base).select("sheet", "row_number", "row_json")


@query("""select page_id, 0::bigint as table_number, '["' || x || '"]' as row_json from (select page_id, unnest(regexp_extract_all(html, '<li><a href="[^"]*">([^<]*)</a></li>', 1)) as x from pages)""")
def html_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of tables in pages: the entries of a page's list are laid out as a table, as the pages hold none."""
    import json

    import pyarrow as pa

    html = F.regexp_replace(F.regexp_replace("html", "<ul>", "<table>"), "</ul>", "</table>")
    html = F.regexp_replace(F.regexp_replace(html, "<li>", "<tr><td>"), "</li>", "</td></tr>")

    def run(batches):
        for batch in batches:
            out = [(i, t, json.dumps(cells, ensure_ascii=False)) for i, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()) for t, cells in sheets.html_tables(text or "")]
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in out], pa.int64()), pa.array([r[1] for r in out], pa.int64()), pa.array([r[2] for r in out], pa.string())], ["page_id", "table_number", "row_json"])

    return table(spark, sf_dir, "pages").select("page_id", html.alias("html")).mapInArrow(run, "page_id long, table_number long, row_json string")


@query("select 'a.zip' as archive, case when i % 2 = 0 then 'deep/inner.zip!n' || i::varchar || '.txt' else 'n' || i::varchar || '.txt' end as member, text, null::varchar as error from (select item_id as i, text from benchmark)")
def zip_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark items as members of a zip, every second one in a zip inside it."""
    base = scratch(spark, "zip")
    Path(local(base)).mkdir(parents=True)
    inner = io.BytesIO()
    with zipfile.ZipFile(local(f"{base}/a.zip"), "w", zipfile.ZIP_DEFLATED) as outer, zipfile.ZipFile(inner, "w", zipfile.ZIP_DEFLATED) as deep:
        for r in table(spark, sf_dir, "benchmark").toLocalIterator():
            (deep if r["item_id"] % 2 == 0 else outer).writestr(f"n{r['item_id']}.txt", r["text"])
        deep.close()
        outer.writestr("deep/inner.zip", inner.getvalue())
        outer.writestr("../escape.txt", "not safe")
    rows = archives.read_members(spark, base)
    return rows.select(F.element_at(F.split("archive", "/"), -1).alias("archive"), "member", F.decode("content", "UTF-8").alias("text"), "error")


@query("select 'p' || (o_orderkey % 7)::varchar as folder, count(*) as rows, 3::bigint as columns, 1::bigint as schemas, 0::bigint as errors, 0::bigint as geo from orders group by 1")
def footer_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows and columns of a tree of Parquet files by their footers alone."""
    base = scratch(spark, "tree")
    rows = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice", F.concat(F.lit("p"), (F.col("o_orderkey") % 7).cast("string")).alias("f"))
    rows.write.partitionBy("f").option("maxRecordsPerFile", 500).parquet(base)
    found = footers.footers(footers.parquet_files(spark, base))
    folder = F.regexp_extract("path", "/f=([^/]*)/", 1).alias("folder")
    return found.groupBy(folder).agg(F.sum("rows").alias("rows"), F.max("columns").cast("long").alias("columns"), F.count_distinct("schema_hash").alias("schemas"), F.count("error").alias("errors"), F.count_if("geo").alias("geo"))


@query("select count(*) as rows, ceil(count(*) / 400.0)::bigint <= 4000 as in_parts, sum(o_orderkey)::bigint as keys, true as complete, true as other_source_is_not, true as refused from orders")
def commit_marker(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A staged commit: its marker, its data, and what a second commit at the same place does."""
    target, who = local(scratch(spark, "commit")), {"path": "orders", "size": 1, "mtime_ns": 2}
    rows = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    marker = commit.commit(rows, target, who, part_rows=400)
    try:
        commit.commit(rows, target, who)
        refused = False
    except commit.CommitError:
        refused = True
    state = F.lit(commit.is_complete(target, who)).alias("complete"), F.lit(not commit.is_complete(target, {**who, "size": 3})).alias("other_source_is_not"), F.lit(refused).alias("refused")
    return spark.read.parquet(target).agg(F.lit(marker["rows"]).cast("long").alias("rows"), F.lit(marker["parts"] <= 4000).alias("in_parts"), F.sum("o_orderkey").alias("keys"), *state)


@query("select 'p' || (c_nationkey % 3)::varchar as part, count(*) as rows, sum(c_custkey)::bigint as keys from customer group by 1")
def published_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Partitions published by links: rows by what publishing says, keys from the published data."""
    base = local(scratch(spark, "publish"))
    c = table(spark, sf_dir, "customer").withColumn("part", F.concat(F.lit("p"), (F.col("c_nationkey") % 3).cast("string")))
    c.select("part", "c_custkey").write.partitionBy("part").parquet("file://" + base + "/raw")
    for p in Path(base, "raw").glob("part=*"):
        p.rename(p.with_name(p.name.removeprefix("part=")))
    totals = commit.publish_partitions(Path(base, "raw"), Path(base, "out"))
    said = spark.createDataFrame([(k, v["rows"]) for k, v in totals["partitions"].items()], "part string, rows long")
    data = spark.read.options(recursiveFileLookup="true", pathGlobFilter="*.parquet").parquet("file://" + base + "/out").withColumn("part", F.regexp_extract(F.col("_metadata.file_path"), "/out/([^/]*)/", 1))
    return data.groupBy("part").agg(F.sum("c_custkey").alias("keys")).join(said, "part").select("part", "rows", "keys")


@query("select line_number, text from (select doc_id, unnest(string_split(text, chr(10))) as text, generate_subscripts(string_split(text, chr(10)), 1)::bigint as line_number from documents where doc_id = (select max(doc_id) from documents)) where text <> ''")
def text_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lines of one text file, numbered."""
    d = table(spark, sf_dir, "documents")
    last = d.agg(F.max_by("text", "doc_id").alias("value"))
    path = one_file(last, f"{scratch(spark, 'text')}/t.txt")
    return plain.read_lines(spark, path).select("line_number", F.regexp_replace("text", "\n$", "").alias("text")).filter("text <> ''")


@query("select 'd' || page_id::varchar || '.html' as source_name, html as data from pages")
def blob_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages as one file each, read back as opaque bytes."""
    base = scratch(spark, "blobs")
    Path(local(base)).mkdir(parents=True)
    folder = local(base)

    def write(batches):
        import pyarrow as pa

        for batch in batches:
            for i, html in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                Path(folder, f"d{i}.html").write_text(html, encoding="utf-8", newline="")
            yield pa.RecordBatch.from_arrays([pa.array([len(batch)], pa.int64())], ["n"])

    table(spark, sf_dir, "pages").select("page_id", "html").mapInArrow(write, "n long").agg(F.sum("n")).collect()
    return plain.read_blob(spark, base).select("source_name", F.decode("data", "UTF-8").alias("data"))


@query("select s_suppkey::varchar as path, s_nationkey as bytes, sha256(s_name) as sha256, s_suppkey % 2 = 0 as partial from supplier")
def manifest_tsv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A manifest written as TSV and read with its types."""
    s = table(spark, sf_dir, "supplier")
    path = f"{scratch(spark, 'tsv')}/m.tsv"
    catalogs.write_tsv(s.select(F.col("s_suppkey").cast("string").alias("path"), F.col("s_nationkey").alias("bytes"), F.sha2("s_name", 256).alias("sha256"), F.when(F.col("s_suppkey") % 2 == 0, "1").otherwise("").alias("partial")), local(path))
    return catalogs.read_manifest(spark, path).withColumn("bytes", F.col("bytes").cast("int"))


@query("select 's' || s_suppkey::varchar as source, case when s_suppkey % 3 = 0 then 'failed' else 'done' end as status, s_nationkey::bigint as rows, case when s_suppkey % 3 = 0 then 'e' end as error from supplier")
def log_jsonl(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records appended to a log one by one, and read."""
    path = local(f"{scratch(spark, 'log')}/migration.jsonl")
    for r in table(spark, sf_dir, "supplier").orderBy("s_suppkey").toLocalIterator():
        k = r["s_suppkey"]
        files.append_jsonl(path, {"source": f"s{k}", "status": "failed" if k % 3 == 0 else "done", "rows": r["s_nationkey"], **({"error": "e"} if k % 3 == 0 else {})})
    return catalogs.read_logs(spark, path).select("source", "status", "rows", "error")


@query("""select 'f' || s_suppkey::varchar || case s_suppkey % 4 when 0 then '.csv' when 1 then '.json' else '.tsv' end as name, case when s_suppkey % 4 = 1 and s_suppkey % 3 = 0 then 'failed' else 'done' end as status,
  case s_suppkey % 4 when 0 then 3 when 1 then case when s_suppkey % 3 = 0 then null else 2 end when 2 then 4 end::bigint as rows from supplier where s_suppkey % 4 <> 3""")
def migrated_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A tree of small CSV, TSV, JSON, broken and non-tabular files migrated to datasets; the log says what became of each."""
    base = Path(local(scratch(spark, "migrate")))
    (base / "raw").mkdir(parents=True)
    for r in table(spark, sf_dir, "supplier").toLocalIterator():
        k = r["s_suppkey"]
        suffix, text = ((".csv", "a,b\n1,2\n3,4\n5,6\n"), (".json", "[" if k % 3 == 0 else '[{"a": 1}, {"a": 2}]'), (".tsv", "a\tb\n1\t2\n1\t2\n1\t2\n1\t2\n"), (".pdf", "%PDF"))[k % 4]
        (base / "raw" / f"f{k}{suffix}").write_text(text)
    migrate.run(spark, f"file://{base}/raw", base / "out", base / "log.jsonl")
    log = catalogs.read_logs(spark, str(base / "log.jsonl"))
    return log.select(F.element_at(F.split("source", "/"), -1).alias("name"), "status", "rows")


@query("select s_name as name, case s_suppkey % 3 when 0 then 'csv.gz' when 1 then 'json.gz' else 'gzip' end as payload from supplier")
def gzip_payload(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a gzip file without a telling suffix holds."""
    k = F.col("s_suppkey") % 3
    text = F.when(k == 0, "a;b\n1;2\n3;4\n").when(k == 1, '[{"a": 1}]').otherwise("plain words only")

    def run(batches):
        import gzip

        import pyarrow as pa

        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([sniff.payload(gzip.compress(t.encode())) for t in batch.column(1).to_pylist()])], ["name", "payload"])

    return table(spark, sf_dir, "supplier").select(F.col("s_name").alias("name"), text.alias("t")).mapInArrow(run, "name string, payload string")


def _numbered(df: DataFrame) -> DataFrame:
    """A sorted report with its row numbers; the whole of it is one partition for that."""
    return df.coalesce(1).withColumn("row_number", F.monotonically_increasing_id() + 1)


@query(f"with {ENTRIES} select reason, count(*) as duplicate_files, sum(bytes)::bigint as bytes, row_number() over (order by sum(bytes) desc, reason) as row_number from dup group by 1")
def reasons_in_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The order of a rollup: bytes, descending."""
    return _numbered(semantic.by_reason(release.duplicates(entries(spark, sf_dir)))).select("reason", "duplicate_files", "bytes", "row_number")


@query(f"with {LOG}, k as (select {CLASS} as class, count(*) as files from l group by 1) select class, files, row_number() over (order by list_position(['complete', 'partial', 'missing', 'ignored', 'unknown'], class)) as row_number from k")
def classes_in_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The order of a reconciliation's totals."""
    return _numbered(reconcile.totals(reconcile.classify(events_log(spark, sf_dir), "/raw"))).select("class", "files", "row_number")
