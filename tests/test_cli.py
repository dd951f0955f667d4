import json

from lodestack.cli import main


def files(root, spark, **rows):
    for name, n in rows.items():
        target = root / name.replace("__", "/")
        target.parent.mkdir(parents=True, exist_ok=True)
        spark.range(n).coalesce(1).write.mode("overwrite").parquet(f"file://{root}/../made/{name}")
        next((root / ".." / "made" / name).glob("*.parquet")).rename(f"{target}.parquet")


def test_corpus_jobs(spark, tmp_path, capsys):
    root, out = tmp_path / "root", tmp_path / "out"
    files(root, spark, vigieau__a_20240101=3, vigieau__b_20240202=3, x__c=5, transport__baac__d=2)
    assert main(["manifest", "--root", str(root), "--store", str(out / "m"), "--output", str(out / "m.tsv"), "--checksum"], spark) == 0
    assert json.loads(capsys.readouterr().out)["files"] == 4
    release = out / "release"
    assert main(["release", "--manifest", str(out / "m.tsv"), "--root", str(root), "--output", str(release), "--mode", "hardlink"], spark) == 0
    assert json.loads(capsys.readouterr().out)["removed_files"] == 1
    assert sorted(p.name for p in release.rglob("*.parquet")) == ["a_20240101.parquet", "c.parquet", "d.parquet"]
    assert main(["release", "--manifest", str(out / "m.tsv"), "--root", str(root), "--output", str(release)], spark) == 1
    assert main(["semantic-audit", "--duplicates", str(release / "_meta" / "duplicates.tsv"), "--output", str(out / "s")], spark) == 0
    assert (out / "s" / "by-reason.tsv").read_text().splitlines()[1].startswith("snapshot-identical\t1")
    assert main(["snapshot-index", "--duplicates", str(release / "_meta" / "duplicates.tsv"), "--manifest", str(release / "_meta" / "manifest.tsv"), "--output", str(out / "i.tsv")], spark) == 0
    assert "2024-02-02" in (out / "i.tsv").read_text()
    assert main(["normalize", "--root", str(root), "--output", str(out / "n.tsv"), "--apply"], spark) == 0
    assert (root / "transport/accidents/baac/d.parquet").exists()
    files(root, spark, transport__baac__d=7)
    assert main(["normalize", "--root", str(root), "--output", str(out / "n.tsv"), "--apply"], spark) == 2
    assert main(["promote", "--source", str(release), "--output", str(out / "p")], spark) == 0
    assert main(["promote", "--source", str(release), "--output", str(out / "p")], spark) == 1


def test_raw_jobs(spark, tmp_path, capsys):
    root = tmp_path / "data"
    (root / "raw" / "d").mkdir(parents=True)
    (root / "raw" / "d" / "a.csv").write_text("x\n1\n")
    (root / "raw" / "d" / "b.rar").write_bytes(b"Rar!\x1a\x07\x00")
    log = str(tmp_path / "log.jsonl")
    raw = str(root / "raw")
    assert main(["migrate", "--root", raw, "--output", str(root / "parquet"), "--log", log, "--preflight"], spark) == 0
    assert main(["migrate", "--root", raw, "--output", str(root / "parquet"), "--log", log], spark) == 0
    assert main(["migrate", "--root", raw, "--output", str(root / "parquet"), "--log", log, "--retry", "ignored"], spark) == 0
    assert main(["reconcile", "--root", str(root), "--logs", log, "--output", str(tmp_path / "r.tsv")], spark) == 0
    assert "d/b.rar\tignored" in (tmp_path / "r.tsv").read_text()
    assert main(["audit", "--root", str(root), "--output", str(tmp_path / "a.tsv")], spark) == 0
    assert "parquet-candidate-present" in (tmp_path / "a.tsv").read_text()
    dump = tmp_path / "d.sql"
    dump.write_text('ALTER TABLE "s"."t" ADD COLUMN "x" int4;\nCOPY "s"."t" ("x") FROM STDIN;\n5\n\\.\n')
    assert main(["convert", "--source", str(dump), "--output", str(tmp_path / "c")], spark) == 0
    assert main(["convert", "--source", str(dump), "--output", str(tmp_path / "c"), "--tables", "nope"], spark) == 1
