import random
from decimal import Decimal
import datetime as dt

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lodestack.functions import copytext, dates, ewkb, jsontext, names, ntriples, pgarray, pgtypes, sniff


@pytest.fixture
def one(spark):
    def run(make, *values, kind="string"):
        df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {kind}")
        return [r[0] for r in df.orderBy("i").select(make(F.col("x"))).collect()]

    return run


def test_copy_fields(one):
    assert one(copytext.split_fields, "a\tb\tc", "a\\\tinside\tb", "a\\\\\tb", "", "x\t", "\t\t", "\\N", "q\\") == [["a", "b", "c"], ["a\\\tinside", "b"], ["a\\\\", "b"], [""], ["x", ""], ["", "", ""], ["\\N"], ["q\\"]]
    assert one(copytext.parse_row, "a\tb\tc", "a\\\tinside\tb", "a\\\\\tb") == [["a", "b", "c"], ["a\tinside", "b"], ["a\\", "b"]]
    assert one(copytext.trailing_backslashes, "a", "a\\", "a\\\\", "\\a") == [0, 1, 2, 0]


def test_unescape(one):
    assert one(copytext.unescape, "\\N", "a\\tb\\n", "a\\\\b", "\\101\\x41\\q\\", "é\\777", "x\\\ny", "\\b\\f\\r\\v", "\\xg", "\\1011", "") == [None, "a\tb\n", "a\\b", "AAq\\", "éǿ", "x\ny", "\b\f\r\v", "xg", "A1", ""]


@settings(max_examples=25, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=st.lists(st.lists(st.one_of(st.none(), st.text(alphabet="ab\\\t\n\r\x0bNé日x1", max_size=12)), min_size=3, max_size=3), min_size=1, max_size=20))
def test_copy_round_trip(spark, rows):
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, a string, b string, c string")
    line = F.concat_ws("\t", *[copytext.escape(F.col(c)) for c in "abc"])
    assert [r[0] for r in df.orderBy("i").select(copytext.parse_row(line)).collect()] == rows


def test_arity(spark):
    bad = spark.createDataFrame([("a\tb",)], "x string").select(copytext.checked(copytext.split_fields(F.col("x")), 3, "s.t"))
    with pytest.raises(Exception, match="expected 3 fields, found 2"):
        bad.collect()


def slow_array(text):
    out, buf, quoted, was = [], "", False, False
    inner, i = text[1:-1], 0
    while i <= len(inner):
        c = inner[i] if i < len(inner) else ","
        if i == len(inner) or (c == "," and not quoted):
            out.append(None if not was and buf.upper() == "NULL" else buf)
            buf, was = "", False
        elif c == "\\":
            i += 1
            buf += inner[i]
        elif c == '"':
            quoted, was = not quoted, True
        else:
            buf += c
        i += 1
    return out


def test_arrays(one):
    assert one(pgarray.parse, '{a,b,"c,d",NULL,"NULL"}', "{}", '{"a\\"b","x\ny"}', "{ }", "{,}") == [["a", "b", "c,d", None, "NULL"], [], ['a"b', "x\ny"], [" "], ["", ""]]
    r = random.Random(1)
    values = [[r.choice([None, "".join(r.choice('ab",\\ \n{}N') for _ in range(r.randrange(5)))]) for _ in range(r.randrange(1, 5))] for _ in range(300)]
    assert one(lambda c: pgarray.parse(pgarray.render(c)), *values, kind="array<string>") == values
    literals = ["{" + ",".join(r.choice(["a", "NULL", "null", '"NULL"', '"a,b"', "a\\,b", '"\\""', "", '"', "\\\\"][:8]) for _ in range(4)) + "}" for _ in range(300)]
    assert one(pgarray.parse, *literals) == [slow_array(x) for x in literals]


@pytest.mark.parametrize("bad", ["a", "{", "{a", 'a}', '{"a}', "{a\\}", ""])
def test_malformed_arrays(one, bad):
    with pytest.raises(Exception, match="malformed array"):
        one(pgarray.parse, bad)


def test_ewkb(one):
    point = "000000000000f03f0000000000000040"
    got = one(ewkb.to_wkb, "01010000206a080000" + point, "0101000000" + point, "\\x0101000000" + point, "0020000001" + "0000086A" + "3ff00000000000004000000000000000")
    assert [bytes(x).hex() for x in got] == ["0101000000" + point] * 3 + ["0000000001" + "3ff00000000000004000000000000000"]


@pytest.mark.parametrize("bad", ["01010000806a080000", "010100004000", "010100001000", "02010000000000", "0101", "0101000020", "zz01000000", "010"])
def test_bad_geometry(one, bad):
    with pytest.raises(Exception):
        one(ewkb.to_wkb, bad)


CASES = [
    ("12", "int4", 12), ("-3", "smallint", -3), ("9000000000", "bigserial", 9000000000), ("1.5", "real", 1.5), ("1e3", "float8", 1000.0), ("12.340", "numeric(17, 3)", Decimal("12.340")), ("7", "decimal(5)", Decimal(7)), ("7.25", "numeric", 7.25),
    ("2026-05-01", "date", dt.date(2026, 5, 1)), ("2026/05/01", "date", dt.date(2026, 5, 1)), ("2026.05.01", "date", dt.date(2026, 5, 1)), ("2025/04/22T22:00:00", "timestamp", dt.datetime(2025, 4, 22, 22)), ("2025.04.22T22:00:00", "timestamp without time zone", dt.datetime(2025, 4, 22, 22)),
    ("2025.04.23T16:48:56.921", "timestamp(3)", dt.datetime(2025, 4, 23, 16, 48, 56, 921000)), ("2025/06/30T23:59:60", "timestamp", dt.datetime(2025, 7, 1)), ("2025-06-30 23:59:60.5", "timestamp", dt.datetime(2025, 7, 1, 0, 0, 0, 500000)),
    ("1", "bool", True), ("0", "boolean", False), (" TRUE ", "bool", True), ("F", "bool", False), ("{a,b}", "text[]", ["a", "b"]), ("{1,NULL,2}", "int4[]", [1, None, 2]), ("x", "varchar(3)", "x"), ("\\x0aff", "bytea", b"\x0a\xff"), ("é", "bytea", b"\xe9"),
    ("12:30:01", "time", dt.time(12, 30, 1)), (None, "int4", None), (None, "int4[]", None),
]


@pytest.mark.parametrize("raw,pg_type,value", CASES)
def test_types(one, raw, pg_type, value):
    got = one(lambda c: pgtypes.decode(c, pg_type), raw)[0]
    assert (bytes(got) if isinstance(got, bytearray) else got) == value


def test_zoned_timestamps(spark):
    df = spark.createDataFrame([("2025-06-30 10:00:00",), ("2025-06-30T12:00:00+02",), ("2025-06-30 12:00:00+02:00",), ("2025-06-30T10:00:00Z",)], "x string")
    got = df.select(F.date_format(pgtypes.decode(F.col("x"), "timestamp(6) with time zone"), "yyyy-MM-dd HH:mm")).collect()
    assert {r[0] for r in got} == {"2025-06-30 10:00"}


@pytest.mark.parametrize("raw,pg_type", [("yes", "bool"), ("x", "int4"), ("2026-13-01", "date"), ("1", "timestamp")])
def test_bad_values_raise(one, raw, pg_type):
    with pytest.raises(Exception):
        one(lambda c: pgtypes.decode(c, pg_type), raw)


@pytest.mark.parametrize("pg_type", ["numeric(50,2)", "money", "int4[][]", "hstore"])
def test_unmapped_types_fail_when_planned(pg_type):
    with pytest.raises(pgtypes.UnsupportedType):
        pgtypes.spark_type(pg_type)


def test_declared_types():
    assert pgtypes.declared_type("numeric(17, 3)") == "numeric(17, 3)"
    assert pgtypes.declared_type(" varchar(3)  NOT NULL DEFAULT 'x'") == "varchar(3)"
    assert pgtypes.spark_type("hstore", fallback=True).simpleString() == "string"
    assert pgtypes.spark_type("geometry(Point,2154)").simpleString() == "binary"


def test_dates(one):
    assert one(dates.extract, "a/2024-05-06/20230102.csv", "x_20230102_", "y2024_05_06z", "none", "120240506", "1999-01-01") == ["2024-05-06", "2023-01-02", "2024-05-06", "", "", ""]


def test_names(one):
    assert one(names.slug, "Été 2024--x ", "!!!", "a") == ["t-2024-x", "dataset", "a"]
    assert one(names.normalized, "Été 2024--x ", "abc D", "ﬁn") == ["ete-2024-x", "abc-d", "fin"]
    assert one(names.format_name, "a/b.tar.gz", "x", "y/.hidden", "q.CSV", "a.b.geojson.gz", "z.tar.ZST") == [".tar.gz", "<no-ext>", "<no-ext>", ".csv", ".geojson.gz", ".tar.zst"]
    assert one(names.ancestors, "a/b/c", "a") == [["a", "a/b"], []]
    assert one(names.parent_key, "a/b c/d", "a") == ["a-b-c", "."]
    assert one(names.stable_name, "x y")[0].startswith("x-y-") and len(one(names.stable_name, "x y")[0]) == 14
    order = one(names.natural_pass, "log-pass10.jsonl", "log.jsonl", "log-pass2.jsonl")
    assert [r["name"] for r in sorted(order)] == ["log.jsonl", "log-pass2.jsonl", "log-pass10.jsonl"]


def test_sniffing(one):
    assert one(sniff.by_suffix, "a.CSV", "b.xml", "c.pdf", "q.geojson.gz", "d/e.ods", "f") == ["csv", None, "non-tabular", "geojson.gz", "ods", None]
    heads = [b"PAR1x", b"PK\x03\x04", b"7z\xbc\xaf\x27\x1c", b"Rar!\x1a\x07", b"BZh9", b"SQLite format 3\x00", b"\x00\x00\x27\x0a", b"\x1f\x8b\x08", b" <?xml <Workbook", b"<html>", b"\n[1]", b"zzz", b""]
    assert one(sniff.by_magic, *heads, kind="binary") == ["parquet", "zip", "7z", "rar", "bzip2", "sqlite", "shapefile", "gzip", "spreadsheetml", "text/xml", "json", "unknown", "unknown"]
    assert one(sniff.json_layout, "[1]", '{"a":1}\n{"b":2}', '{"a":\n1}', "  ", "x") == ["array", "lines", "object", "empty", "unknown"]


def test_json_text(spark, one):
    assert one(jsontext.items, '[1, "q", null, {"b":1,"a":[2.5]}, true, "1"]', "[1,", "{}", "[]") == [["1", '"q"', "null", '{"b":1,"a":[2.5]}', "true", '"1"'], None, None, []]
    df = spark.createDataFrame([('{"b":[1,"x",{"z":1,"a":2}],"a":"s","e":[],"o":{"k":1},"n":null,"f":2.5,"t":true}',)], "t string")
    got = [tuple(r) for r in jsontext.members(df, "t").collect()]
    assert got == [("b", "array-item", 0, "1"), ("b", "array-item", 1, '"x"'), ("b", "array-item", 2, '{"z":1,"a":2}'), ("a", "scalar", None, '"s"'), ("e", "empty-array", None, "[]"), ("o", "object", None, '{"k":1}'), ("n", "scalar", None, "null"), ("f", "scalar", None, "2.5"), ("t", "scalar", None, "true")]
    assert one(jsontext.lines, "a\nb\r\nc\rd", "x\n", "", "\n\n") == [["a\n", "b\r\n", "c\r", "d"], ["x\n"], [], ["\n", "\n"]]
    assert one(jsontext.null_token, "", "null", "NULL", "Null", "x") == [None, None, None, "Null", "x"]


def test_ntriples(spark):
    df = spark.createDataFrame([('<a> <b> "c d . e"@fr .',), ("",), ("_:x <p> <o> .\r",), ("<s> <p> _:y .",), ("<s> <p> 5 .",)], "value string")
    assert [tuple(r) for r in ntriples.triples(df).collect()] == [("<a>", "<b>", '"c d . e"@fr', "literal"), ("_:x", "<p>", "<o>", "iri"), ("<s>", "<p>", "_:y", "bnode"), ("<s>", "<p>", "5", "other")]
    with pytest.raises(Exception, match="not an N-Triples line"):
        ntriples.triples(spark.createDataFrame([("<a> <b> <c>",)], "value string")).collect()


def test_very_long_values(spark):
    """Fields, elements and payloads of 300,000 characters with many escapes: no recursion by length."""
    text = "ab\t\\\n\"{}," * 30_000
    row = spark.createDataFrame([(text,)], "t string").select(
        copytext.parse_row(F.concat_ws("\t", copytext.escape(F.col("t")), F.lit("x"))).alias("f"), pgarray.parse(pgarray.render(F.array("t", F.lit("y")))).alias("a"), F.length(ewkb.to_wkb(F.repeat(F.lit("00"), 200_000))).alias("n")
    ).first()
    assert list(row["f"]) == [text, "x"] and list(row["a"]) == [text, "y"]
