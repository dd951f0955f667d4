"""Every registered query against its SQL in DuckDB on the smallest tables, and the catalog operators on small cases."""

import duckdb
import pytest

import lodestack.queries  # noqa: F401
from lodestack.operators import matching, release, snapshot
from lodestack.registry import ORACLES, QUERIES

DATA = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"create view {t} as select * from read_parquet('{DATA}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, DATA)
    columns = sorted(df.columns)
    got = [tuple(r) for r in df.select(columns).collect()]
    if name not in ORACLES:
        assert got
        return
    found = duck.execute(ORACLES[name])
    names = [d[0] for d in found.description]
    assert sorted(names) == columns
    at = [names.index(c) for c in columns]
    want = [tuple(r[i] for i in at) for r in found.fetchall()]
    assert sorted(map(repr, got)) == sorted(map(repr, want))


def test_entry():
    import __spark_entry__

    assert "dedup_release" in __spark_entry__.queries() and set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


def test_duplicate_reasons(spark):
    cases = [
        ("vigieau/a/x", "vigieau/b/x", "snapshot-identical"), ("q/repertoire-national/a", "repertoire-national/b", "snapshot-identical"), ("a-zip-b/x", "c/x", "archive-vs-standalone"), ("a.zip/x", "c/x", "archive-vs-standalone"),
        ("a/Export au format CSV", "b/x", "duplicate-export"), ("a/x.csv", "b/x.csv", "dataset-alias"), ("a/x.csv", "a/y.csv", "exact-duplicate"),
    ]
    df = spark.createDataFrame(cases, "c string, d string, want string")
    assert df.filter(release.duplicate_reason(df["c"], df["d"]) != df["want"]).count() == 0


def test_canonical_choice(spark):
    paths = ["tmp/a", "b-zip-c/a", "deep/er/a", "z/a", "y/a", ".h/a", "q.staging/a"]
    df = spark.createDataFrame([(p, 5, "s", False) for p in paths] + [("only", 1, "t", True)], "path string, bytes long, sha256 string, partial boolean")
    assert {r["sha256"]: (r["path"], r["copies"]) for r in release.canonical(df).collect()} == {"s": ("y/a", 7), "t": ("only", 1)}
    s = release.summary(df).first()
    assert (s["source_files"], s["release_files"], s["removed_files"], s["duplicate_groups"], s["partial_files"]) == (8, 2, 6, 1, 1)
    assert release.summary(df.limit(0)).first()["source_files"] == 0


def test_renames(spark):
    rows = [("a", "b", "move"), ("b", "c", "drop-source-duplicate"), ("c", "d", "move"), ("x", "y", "move"), ("y", "x", "move"), ("s", "s", "move"), ("n", "m", "conflict-size")]
    plan = spark.createDataFrame(rows, "source string, destination string, action string")
    assert {r["source"]: r["current"] for r in snapshot.resolve(snapshot.rename_map(plan)).collect()} == {"a": "d", "b": "d", "c": "d", "x": "x", "y": "y", "s": "s"}
    dup = spark.createDataFrame([("h", "a", "old/2024-01-02/f", 3, "snapshot-identical"), ("i", "z", "o/f", 1, "snapshot-identical"), ("j", "z", "o/f", 1, "exact-duplicate")], "sha256 string, canonical_path string, duplicate_path string, bytes long, reason string")
    now = spark.createDataFrame([("h", "d"), ("h", "e"), ("k", "z")], "sha256 string, path string")
    assert [tuple(r) for r in snapshot.index(dup, now, snapshot.rename_map(plan)).collect()] == [("i", "", "o/f", "", 1, "identical-snapshot"), ("h", "d", "old/2024-01-02/f", "2024-01-02", 3, "identical-snapshot")]


def layer(spark, *paths):
    return spark.createDataFrame([(p, 10, 1, ".x:1") for p in paths], "relative_path string, bytes long, files int, formats string")


def test_layers(spark):
    raw = layer(spark, "domain/dataset-a", "domain/dataset-b", "a/b/dataset-x", "p/q", "alone")
    numpy = layer(spark, "domain/dataset-a", "other/dataset-x", "p/q/01", "p/q/02", "lost")
    parquet = layer(spark, "domain/dataset-b", "lost-too")
    rows = {r["raw_path"] or r["numpy_path"] or r["parquet_path"]: r for r in matching.audit(raw, numpy, parquet).collect()}
    assert {k: r["status"] for k, r in rows.items()} == {"domain/dataset-a": "legacy-only", "domain/dataset-b": "parquet-candidate-present", "a/b/dataset-x": "legacy-only", "p/q": "legacy-only", "alone": "raw-only", "lost": "orphan-numpy", "lost-too": "orphan-parquet"}
    assert (rows["a/b/dataset-x"]["numpy_score"], rows["a/b/dataset-x"]["numpy_match"]) == (70, "same-name")
    assert (rows["p/q"]["numpy_path"], rows["p/q"]["numpy_match"]) == ("p/q/01;p/q/02", "one-to-many-structural")
    tied = matching.best(matching.scored(layer(spark, "r/dataset-x"), layer(spark, "a/dataset-x", "b/dataset-x"))).first()
    assert (tied["path"], tied["score"], tied["reason"]) == (None, 0, "ambiguous")


def test_inventory(spark):
    files = [("domain/dataset-x/dataset.json", 1), ("domain/dataset-x/manifest.json", 2), ("domain/dataset-x/t/part-0.parquet", 5), ("plain/a.csv", 3), ("plain/deep/b.csv", 4), (".hidden/c.csv", 9), ("plain/deep/.d/e.csv", 9)]
    got = matching.inventory(spark.createDataFrame(files, "path string, bytes long"), "parquet").collect()
    assert [(r["relative_path"], r["bytes"], r["files"], r["formats"]) for r in got] == [("domain/dataset-x", 8, 3, ".json:2,.parquet:1"), ("plain/deep", 4, 1, ".csv:1")]
    fast = spark.createDataFrame([("d", '{"bytes": 7, "ntriples_files": 1, "csv_files": 2}'), ("e", "{}")], "relative_path string, json string")
    assert [tuple(r) for r in matching.fast_inventory(fast).collect()] == [("parquet", "d", 7, 3, ".parquet:manifest")]


def test_ranks_with_an_outlier(spark, monkeypatch):
    """One far key doesn't put all others into one range; negative and repeated keys."""
    from lodestack.operators import ranking

    for name, value in (("RANGES", 10), ("LARGE", 4), ("FINER", 5)):
        monkeypatch.setattr(ranking, name, value)
    keys = [*range(-40, 60), *[7] * 9, 10**15, -(10**12)]
    df = spark.createDataFrame([(k,) for k in keys], "k long").repartition(4)
    got = sorted((r["rank"], r["k"]) for r in ranking.ranked(df, "k").collect())
    assert [r for r, _ in got] == list(range(1, len(keys) + 1)) and [k for _, k in got] == sorted(keys)
    assert ranking.ranked(df.limit(0), "k").count() == 0
