"""Datasets of the raw, legacy and Parquet layers: inventory, scored matching, audit.

No pair of datasets is compared that doesn't share a key: equal paths, an ancestor (exploded to
an equality), a normalised leaf name, or a token of it within the same parent.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestack.functions import names

# Scores by reason, and reasons of structure.
EXACT, RAW_PARENT, DERIVED_PARENT, PARENT_NAME, NAME, SIMILAR = (100, "exact-path"), (95, "raw-parent-of-derived"), (85, "derived-parent-of-raw"), (90, "same-parent+name"), (70, "same-name"), (60, "same-parent+similar-name")
STRUCTURAL = ("exact-path", "raw-parent-of-derived", "derived-parent-of-raw", "same-parent+name")
MANY_ALLOWED = ("exact-path", "raw-parent-of-derived", "derived-parent-of-raw")
MARKERS = ("dataset.json", "manifest.json", "manifest.parquet")


def formats(files: DataFrame, key: str) -> DataFrame:
    """key, bytes, files, formats (`ext:n`, the most frequent first) of file rows (key, path, bytes)."""
    each = files.groupBy(key, names.format_name(F.col("path")).alias("ext")).agg(F.count("*").alias("n"), F.sum("bytes").alias("bytes"))
    listed = F.transform(F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("less"), "ext", "n"))), lambda x: F.concat(x["ext"], F.lit(":"), x["n"].cast("string")))
    return each.groupBy(key).agg(F.sum("bytes").alias("bytes"), F.sum("n").cast("int").alias("files"), F.array_join(listed, ",").alias("formats"))


def inventory(files: DataFrame, layer: str) -> DataFrame:
    """Datasets of a layer from its files (relative path, bytes): layer, relative_path, bytes, files, formats.

    A folder with a marker is a dataset with all below it; else a folder with files is one unless
    a folder below it has files. Hidden folders are left out.
    """
    visible = files.filter(~F.exists(F.slice(F.split("path", "/"), 1, F.greatest(F.size(F.split("path", "/")) - 1, F.lit(1))), lambda p: p.startswith(".")))
    rows = visible.filter(F.col("path").contains("/")).withColumn("folder", names.parent(F.col("path"))).withColumn("name", names.leaf(F.col("path")))
    marker = F.col("name").isin(*MARKERS) if layer == "parquet" else F.col("name").endswith(".done.json") if layer == "numpy" else F.lit(False)
    bounds = rows.filter(marker).select(F.col("folder").alias("bound")).distinct()
    above = rows.select("path", "bytes", "folder", F.explode(F.array_append(names.ancestors(F.col("folder")), F.col("folder"))).alias("bound"))
    inside = above.join(bounds, "bound").groupBy("path", "bytes").agg(F.min_by("bound", F.length("bound")).alias("dataset"))
    outside = rows.join(inside.select("path"), "path", "left_anti").select("path", "bytes", F.col("folder").alias("dataset"))
    upper = rows.select(F.explode(names.ancestors(F.col("folder"))).alias("dataset")).distinct()
    leaves = outside.join(upper, "dataset", "left_anti").select("path", "bytes", "dataset")
    return formats(inside.unionByName(leaves), "dataset").select(F.lit(layer).alias("layer"), F.col("dataset").alias("relative_path"), "bytes", "files", "formats").orderBy("relative_path")


def fast_inventory(markers: DataFrame) -> DataFrame:
    """Datasets from their markers' own totals (relative_path, json): those whose marker tells bytes and files."""
    spec = "bytes bigint, files bigint, ntriples_files bigint, csv_files bigint"
    m = markers.select("relative_path", F.from_json("json", spec).alias("m"))
    count = F.coalesce("m.files", F.col("m.ntriples_files") + F.col("m.csv_files"))
    return m.select(F.lit("parquet").alias("layer"), "relative_path", F.col("m.bytes").alias("bytes"), count.cast("int").alias("files"), F.lit(".parquet:manifest").alias("formats")).filter("bytes is not null and files is not null")


def _keyed(datasets: DataFrame, side: str) -> DataFrame:
    path = F.col("relative_path")
    out = datasets.select(path, names.normalized(names.leaf(path)).alias("leaf"), names.parent_key(path).alias("parent"), "bytes")
    tokens = F.array_distinct(F.filter(F.split("leaf", "-"), lambda t: F.length(t) >= 4))
    return out.withColumn("tokens", tokens).select(*[F.col(c).alias(f"{side}_{c}") for c in ("relative_path", "leaf", "parent", "bytes", "tokens")])


def _alike(a: DataFrame, b: DataFrame) -> DataFrame:
    """Pairs below one parent that share at least two tokens and three quarters of them all.

    Such a pair shares one of the leading tokens of each side, the rarest of the parent, so a token
    that many of a parent's datasets have joins none of them as long as they have rarer ones.
    """
    every = a.select(F.col("s_parent").alias("parent"), F.explode("s_tokens").alias("token")).unionByName(b.select(F.col("t_parent").alias("parent"), F.explode("t_tokens").alias("token")))
    number = every.groupBy("parent", "token").agg(F.count("*").alias("n"))

    def leading(rows: DataFrame, side: str) -> DataFrame:
        own = rows.withColumn("parent", F.col(f"{side}_parent")).withColumn("token", F.explode(f"{side}_tokens")).join(number, ["parent", "token"])
        keep = [c for c in rows.columns if c != f"{side}_tokens"]
        rare = own.groupBy("parent", *keep).agg(F.transform(F.sort_array(F.collect_list(F.struct("n", "token"))), lambda x: x["token"]).alias(f"{side}_rare"))
        n = F.size(f"{side}_rare")
        return rare.withColumn("token", F.explode(F.slice(f"{side}_rare", F.lit(1), n - F.ceil(n * 0.75).cast("int") + 1)))

    found = leading(a, "s").join(leading(b, "t"), ["parent", "token"])
    common = F.size(F.array_intersect("s_rare", "t_rare"))
    return found.filter((common >= 2) & (common / (F.size("s_rare") + F.size("t_rare") - common) >= 0.75))


def scored(sources: DataFrame, targets: DataFrame, same_name: bool = True) -> DataFrame:
    """raw_path, target_path, target_bytes, score, reason of every pair that matches, by the first rule that holds.

    Without same_name, pairs that share nothing but a leaf name are left out: their number grows
    with the square of a common name's count.
    """
    a, b = _keyed(sources, "s"), _keyed(targets, "t")
    pair = ["s_relative_path", "t_relative_path", "t_bytes"]

    def found(joined: DataFrame, *rules: tuple) -> DataFrame:
        """Pairs with the first of the rules (condition, (score, reason), rank) that holds."""
        rule = None
        for condition, (score, reason), rank in rules:
            value = F.struct(F.lit(score).alias("score"), F.lit(reason).alias("reason"), F.lit(rank).alias("rank"))
            rule = value if condition is None and rule is None else rule.otherwise(value) if condition is None else (F if rule is None else rule).when(condition, value)
        return joined.select(*pair, rule.alias("m"))

    path = F.col("t_relative_path")
    below = b.withColumn("up", F.explode(F.array_append(names.ancestors(path), path)))
    lower = a.join(below, a["s_relative_path"] == below["up"])
    above = a.withColumn("up", F.explode(names.ancestors(F.col("s_relative_path"))))
    upper = above.join(b, above["up"] == path)
    same_parent = F.col("s_parent") == F.col("t_parent")
    leaf = a.join(b, (a["s_leaf"] == b["t_leaf"]) if same_name else (a["s_leaf"] == b["t_leaf"]) & same_parent)
    alike = _alike(a, b)
    every = [
        found(lower, (F.col("s_relative_path") == path, EXACT, 0), (None, RAW_PARENT, 1)), found(upper, (None, DERIVED_PARENT, 2)),
        found(leaf, (same_parent, PARENT_NAME, 3), (None, NAME, 4)), found(alike, (None, SIMILAR, 5)),
    ]
    best = reduce(DataFrame.unionByName, every).groupBy(*pair).agg(F.min_by("m", F.col("m.rank")).alias("m"))
    return best.select(F.col("s_relative_path").alias("raw_path"), path.alias("target_path"), F.col("t_bytes").alias("target_bytes"), "m.score", "m.reason")


def matches(pairs: DataFrame) -> DataFrame:
    """One row a source: its best target (path, bytes, score, reason) and its structural matches (n, paths, all_bytes, targets).

    Two aggregations, no window: by score, which tells ties, then over the scores.
    """
    is_structural = (F.col("score") >= 85) & F.col("reason").isin(*STRUCTURAL)
    target = F.struct(names.depth(F.col("target_path")).alias("depth"), F.col("target_path").alias("path"), F.col("target_bytes").alias("bytes"), "reason")
    by_score = pairs.groupBy("raw_path", "score").agg(F.min(target).alias("top"), F.count("*").alias("ties"), F.count_if(is_structural).alias("n"), F.collect_list(F.when(is_structural, F.col("target_path"))).alias("targets"), F.sum(F.when(is_structural, F.col("target_bytes"))).alias("all_bytes"))
    rows = by_score.groupBy("raw_path").agg(F.max_by(F.struct("top", "ties", "score"), "score").alias("b"), F.sum("n").alias("n"), F.sort_array(F.flatten(F.collect_list("targets"))).alias("targets"), F.sum("all_bytes").alias("all_bytes"))
    unclear = (F.col("b.ties") > 1) & ~F.col("b.top.reason").isin(*MANY_ALLOWED)
    return rows.select(
        "raw_path", F.when(~unclear, F.col("b.top.path")).alias("path"), F.when(~unclear, F.col("b.top.bytes")).alias("bytes"), F.when(unclear, 0).otherwise(F.col("b.score")).alias("score"),
        F.when(unclear, "ambiguous").otherwise(F.col("b.top.reason")).alias("reason"), "n", F.array_join("targets", ";").alias("paths"), "all_bytes", "targets", F.col("b.score").alias("top_score"),
    )


def all_matches(sources: DataFrame, targets: DataFrame) -> DataFrame:
    """matches of all sources. Targets that share only a leaf name are counted by name, never paired.

    Where no better rule holds, a source's name decides: one target of that name is its match, more are ambiguous.
    """
    found = matches(scored(sources, targets, same_name=False))
    a, b = _keyed(sources, "s"), _keyed(targets, "t")
    leaf = b.groupBy("t_leaf").agg(F.count("*").alias("same"), F.min(F.struct(names.depth(F.col("t_relative_path")).alias("depth"), F.col("t_relative_path").alias("path"), F.col("t_bytes").alias("bytes"))).alias("one"))
    named = a.join(leaf, a["s_leaf"] == leaf["t_leaf"], "left").select(F.col("s_relative_path").alias("raw_path"), "same", "one")
    rows = named.join(found, "raw_path", "left")
    by_name = F.col("same").isNotNull() & (F.coalesce("top_score", F.lit(0)) < NAME[0])
    single = by_name & (F.col("same") == 1)
    return rows.select(
        "raw_path", F.when(by_name, F.when(single, F.col("one.path"))).otherwise(F.col("path")).alias("path"), F.when(by_name, F.when(single, F.col("one.bytes"))).otherwise(F.col("bytes")).alias("bytes"),
        F.when(single, NAME[0]).when(by_name, 0).otherwise(F.col("score")).alias("score"), F.when(single, NAME[1]).when(by_name, "ambiguous").otherwise(F.col("reason")).alias("reason"), "n", "paths", "all_bytes", "targets",
    ).filter("reason is not null")


def best(pairs: DataFrame) -> DataFrame:
    """raw_path, path, bytes, score, reason: the best target of each source; a tie is `ambiguous`, but for exact and ancestor matches."""
    return matches(pairs).select("raw_path", "path", "bytes", "score", "reason")


def structural(pairs: DataFrame) -> DataFrame:
    """raw_path, n, paths (joined by `;`), all_bytes over all structural matches."""
    return matches(pairs).filter("n > 0").select("raw_path", "n", "paths", "all_bytes")


def _side(raw: DataFrame, found: DataFrame, side: str) -> DataFrame:
    rows = raw.select("raw_path").join(found, "raw_path", "left")
    size = F.coalesce("all_bytes", "bytes", F.lit(0))
    present = (F.coalesce("n", F.lit(0)) > 0) | (F.col("path").isNotNull() & (F.col("score") >= 60))
    return rows.select(
        "raw_path", F.when(F.col("n") > 1, F.col("paths")).otherwise(F.coalesce("path", F.lit(""))).alias(f"{side}_path"), names.gib(size).alias(f"{side}_gib"),
        F.when(F.col("n") > 1, "one-to-many-structural").otherwise(F.coalesce("reason", F.lit(""))).alias(f"{side}_match"), F.coalesce("score", F.lit(0)).alias(f"{side}_score"), F.coalesce(present, F.lit(False)).alias(f"{side}_present"),
    )


def _orphans(targets: DataFrame, found: DataFrame, side: str) -> DataFrame:
    chosen = found.select(F.explode(F.array_append(F.coalesce("targets", F.array().cast("array<string>")), F.col("path"))).alias("path")).filter("path is not null")
    rows = targets.join(chosen, targets["relative_path"] == F.col("path"), "left_anti")
    other = "parquet" if side == "numpy" else "numpy"
    return rows.select(
        F.lit("").alias("raw_path"), F.lit("0.000").alias("raw_gib"), F.lit(0).alias("raw_files"), F.lit("").alias("raw_formats"), F.col("relative_path").alias(f"{side}_path"), names.gib(F.col("bytes")).alias(f"{side}_gib"),
        F.lit("unmatched").alias(f"{side}_match"), F.lit(0).alias(f"{side}_score"), F.lit("").alias(f"{other}_path"), F.lit("0.000").alias(f"{other}_gib"), F.lit("").alias(f"{other}_match"), F.lit(0).alias(f"{other}_score"),
        F.lit(f"orphan-{side}").alias("status"), F.lit("manual-review").alias("action"),
    )


def audit(raw: DataFrame, numpy: DataFrame, parquet: DataFrame) -> DataFrame:
    """Every raw dataset with its legacy and Parquet matches, status and action; then derived datasets that nothing matched."""
    in_numpy, in_parquet = all_matches(raw, numpy), all_matches(raw, parquet)
    sources = raw.select(F.col("relative_path").alias("raw_path"), names.gib(F.col("bytes")).alias("raw_gib"), F.col("files").alias("raw_files"), F.col("formats").alias("raw_formats"))
    rows = sources.join(_side(sources, in_numpy, "numpy"), "raw_path").join(_side(sources, in_parquet, "parquet"), "raw_path")
    status = F.when(F.col("parquet_present"), "parquet-candidate-present").when(F.col("numpy_present"), "legacy-only").otherwise("raw-only")
    rows = rows.withColumn("status", status).withColumn("action", F.when(F.col("parquet_present"), "validate-parquet").otherwise("convert-raw-to-parquet")).drop("numpy_present", "parquet_present")
    return rows.unionByName(_orphans(numpy, in_numpy, "numpy")).unionByName(_orphans(parquet, in_parquet, "parquet"))


def audit_summary(rows: DataFrame) -> DataFrame:
    """status, datasets, queued_gib (to convert), legacy_gib."""
    size = F.col("raw_gib").cast("double")
    return rows.groupBy("status").agg(F.count("*").alias("datasets"), F.sum(F.when(F.col("action") == "convert-raw-to-parquet", size).otherwise(0.0)).alias("queued_gib"), F.sum(F.when(F.col("status") == "legacy-only", F.col("numpy_gib").cast("double")).otherwise(0.0)).alias("legacy_gib"))
