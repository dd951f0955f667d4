"""Plans that move files to a normal layout: prefix rules, names with a kind and date, year folders."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Prefixes and what they become, with the reason.
RULES = (
    ("energie/consommation-electricite-gaz", "energie/consommation", "normalize-energy-consumption"),
    ("energie/installations/registre", "energie/renouvelables/registre-installations", "normalize-energy-installations"),
    ("transport/baac", "transport/accidents/baac", "normalize-baac"),
    ("transport/infrastructures-ferroviaires/voies-rfn", "transport/infrastructures-ferroviaires/rfn/voies", "normalize-rfn-voies"),
    ("transport/infrastructures-ferroviaires/lignes-rfn", "transport/infrastructures-ferroviaires/rfn/lignes", "normalize-rfn-lignes"),
)
DATED_NAME = r"^rna_(import|waldec)_(20\d{2})(\d{2})(\d{2})_.*\.parquet$"
YEAR_FOLDER = r"^cartes?-des-zones-et-arr-t-s-en-vigueur-geojson-(20\d{2})$"


def by_prefix(files: DataFrame, rules: tuple[tuple[str, str, str], ...] = RULES) -> DataFrame:
    """source, destination, reason of files (path) below a rule's prefix. The rules are few, so each is an expression."""
    target, reason = None, None
    path = F.col("path")
    for old, new, why in rules:
        inside = path.startswith(old + "/")
        target = (F if target is None else target).when(inside, F.concat(F.lit(new), F.substring(path, F.lit(len(old) + 1), F.length(path))))
        reason = (F if reason is None else reason).when(inside, F.lit(why))
    return files.filter(path.endswith(".parquet")).select(path.alias("source"), target.alias("destination"), reason.alias("reason")).filter("destination is not null").orderBy("source")


def by_dated_name(files: DataFrame) -> DataFrame:
    """source, destination (kind/date/name), kind, date of registry files below a folder."""
    name = F.element_at(F.split("path", "/"), -1)
    kind, date = F.regexp_extract(name, DATED_NAME, 1), F.concat_ws("-", *[F.regexp_extract(name, DATED_NAME, k) for k in (2, 3, 4)])
    rows = files.filter(F.col("path").contains("/") & name.rlike(DATED_NAME)).select(F.col("path").alias("source"), F.concat_ws("/", kind, date, name).alias("destination"), kind.alias("kind"), date.alias("date"))
    return rows.filter("source <> destination").orderBy("source")


def by_year_folder(files: DataFrame) -> DataFrame:
    """source, destination, year of Parquet files in geojson/<folder with a year>/."""
    parts = F.split("path", "/")
    year = F.regexp_extract(parts[1], YEAR_FOLDER, 1)
    rows = files.filter((F.size(parts) > 2) & (parts[0] == "geojson") & F.col("path").endswith(".parquet")).withColumn("year", year).filter("year <> ''")
    rest = F.array_join(F.slice(parts, 3, F.size(parts) - 2), "/")
    return rows.select(F.col("path").alias("source"), F.concat_ws("/", F.lit("geojson"), "year", rest).alias("destination"), "year").filter("source <> destination").orderBy("source")


def actions(plan: DataFrame, files: DataFrame) -> DataFrame:
    """The plan with an action: move, drop-source-duplicate, conflict-destination-not-file, conflict-size or conflict-sha256.

    files: path, bytes, sha256 (null unless the sizes are equal, see to_hash), is_file. Two sources
    of one destination conflict as conflict-collision.
    """
    state = files.select("path", "bytes", "sha256", "is_file")
    s = state.select(F.col("path").alias("source"), F.col("bytes").alias("s_bytes"), F.col("sha256").alias("s_sha"), F.col("is_file").alias("s_file"))
    d = state.select(F.col("path").alias("destination"), F.col("bytes").alias("d_bytes"), F.col("sha256").alias("d_sha"), F.col("is_file").alias("d_file"))
    twice = plan.groupBy("destination").agg(F.count("*").alias("sources"))
    rows = plan.join(s, "source").filter("s_file").join(d, "destination", "left").join(twice, "destination")
    action = F.when(F.col("sources") > 1, "conflict-collision").when(F.col("d_file").isNull(), "move").when(~F.col("d_file"), "conflict-destination-not-file")
    action = action.when(F.col("s_bytes") != F.col("d_bytes"), "conflict-size").when(F.col("s_sha") != F.col("d_sha"), "conflict-sha256").otherwise("drop-source-duplicate")
    return rows.select(*plan.columns, action.alias("action")).orderBy("source")


def to_hash(plan: DataFrame, sizes: DataFrame) -> DataFrame:
    """Paths (source and destination) whose digests a plan needs: those of pairs of equal size (sizes: path, bytes)."""
    s = sizes.select(F.col("path").alias("source"), F.col("bytes").alias("s_bytes"))
    d = sizes.select(F.col("path").alias("destination"), F.col("bytes").alias("d_bytes"))
    pairs = plan.join(s, "source").join(d, "destination").filter("s_bytes = d_bytes")
    return pairs.select(F.explode(F.array("source", "destination")).alias("path")).distinct()


def collisions(outputs: DataFrame, key: str = "output") -> DataFrame:
    """output, sources, paths of outputs that more than one source would write."""
    return outputs.groupBy(key).agg(F.count("*").alias("sources"), F.array_join(F.sort_array(F.collect_list("path")), ";").alias("paths")).filter("sources > 1").orderBy(key)


def first_conflicts(planned: DataFrame, most: int = 20) -> DataFrame:
    """The first conflicts of a plan, as a report shows them."""
    return planned.filter(F.col("action").startswith("conflict")).orderBy("source").limit(most)
