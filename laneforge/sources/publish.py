"""Writing: feature tables, tallies, partitions with their manifest, and the archive itself."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from laneforge.operators import documents
from laneforge.operators.gates import GateFailed, schema_drift
from laneforge.sources import shared

PARTITION = ["patch", "region", "queue", "bracket"]
PART_ROWS = 20_000


def write_features(tables: dict[str, DataFrame], root: str) -> dict[str, int]:
    """Each table as a folder of Parquet parts, after its columns are held against the specification; the rows of each, counted as they are written."""
    drift = [line for name, df in tables.items() for line in schema_drift(df, name)]
    if drift:
        raise GateFailed("; ".join(drift))
    counted = {}
    for name, df in tables.items():
        seen = Observation(name)
        df.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").option("compression", "zstd").parquet(f"{root}/{name}")
        counted[name] = seen.get["rows"]
    return counted


def write_tallies(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


# ---- published documents -----------------------------------------------------------------
#
# builds/<build>/<kind>     the documents of one build of one partition, never changed
# manifests/<number>        one file of entries: each partition with the build that stands for it
#
# A reader takes the manifest of the highest number and the builds that it names.

KINDS = {"tier_list": documents.TIER_LIST, "champions": documents.CHAMPIONS, "matchups": documents.MATCHUPS}
ENTRY = "patch STRING, region STRING, queue INT, bracket STRING, build STRING, built_at TIMESTAMP, first_day DATE, last_day DATE, source STRING"


def manifest_numbers(spark: SparkSession, root: str) -> list[int]:
    return [int(f.rsplit("/", 1)[1]) for f in shared.folders(spark, f"{root}/manifests/[0-9]*")]


def read_manifest(spark: SparkSession, root: str, number: int | None = None) -> DataFrame:
    """The entries of a manifest, of the last one if none is named; no entries before the first publication."""
    numbers = manifest_numbers(spark, root)
    if number is None and not numbers:
        return spark.createDataFrame([], ENTRY)
    return spark.read.schema(ENTRY).json(f"{root}/manifests/{numbers[-1] if number is None else number:08d}")


def publish_partition(found: dict[str, DataFrame], root: str, entry: dict) -> int:
    """Publishes a partition's documents of all kinds under a new build, then a manifest that names it; the manifest's number.

    ``entry`` has the fields of the manifest but ``build``. Documents are written to the build's own folder, so a reader of an
    earlier manifest goes on with what that names, and a build that fails leaves no trace in any manifest.
    """
    spark = next(iter(found.values())).sparkSession
    if set(found) != set(KINDS):
        raise ValueError(f"a partition has documents of {', '.join(KINDS)}")
    build = uuid.uuid4().hex
    for kind, df in found.items():
        df.write.json(f"{root}/builds/{build}/{kind}")
    new = spark.createDataFrame([{**entry, "build": build}], ENTRY)
    numbers = manifest_numbers(spark, root)
    known = read_manifest(spark, root, numbers[-1]) if numbers else new.limit(0)
    number = numbers[-1] + 1 if numbers else 1
    aside = f"{root}/manifests/_{build}"
    merge_manifest(known, known.limit(0), new).coalesce(1).write.json(aside)  # a row for each partition
    if shared.folders(spark, f"{root}/manifests/{number:08d}"):
        raise FileExistsError(f"another publication has made manifest {number}")
    shared.move(spark, aside, f"{root}/manifests/{number:08d}")
    return number


def read_documents(spark: SparkSession, root: str, kind: str, entries: DataFrame) -> DataFrame:
    """The documents of a kind that a manifest's ``entries`` name, parsed once, with ``build`` and ``_broken``, the text of a line that is no document."""
    builds = [r.build for r in entries.select("build").distinct().collect()]  # one for each partition
    paths = [p for b in builds for p in shared.folders(spark, f"{root}/builds/{b}/{kind}")]
    schema = f"{KINDS[kind]}, _broken STRING"
    if not paths:
        return spark.createDataFrame([], f"{schema}, build STRING")
    rows = spark.read.schema(schema).option("columnNameOfCorruptRecord", "_broken").json(paths)
    return shared.stored(rows.withColumn("build", F.regexp_extract(F.col("_metadata.file_path"), "/builds/([0-9a-f]+)/", 1)), "documents")


def verify_tree(spark: SparkSession, root: str, min_cell_n: int = 100, number: int | None = None) -> DataFrame:
    """What is wrong with the documents on disk that a manifest names (the last, if none is given), found once and stored."""
    entries = shared.stored(read_manifest(spark, root, number), "entries")
    found = {kind: read_documents(spark, root, kind, entries) for kind in KINDS}
    return shared.stored(documents.tree_problems(entries, found, min_cell_n), "problems")


def entries_of_tree(spark: SparkSession, root: str) -> DataFrame:
    """A manifest's entries made anew from the tree: of each partition the latest build that was written whole, by its tier list's own envelope."""
    ended = [{f.split("/")[-3] for f in shared.folders(spark, f"{root}/builds/*/{kind}/_SUCCESS")} for kind in KINDS]
    paths = [f"{root}/builds/{build}/tier_list" for build in sorted(set.intersection(*ended))]  # one for each build of a partition
    if not paths:
        return spark.createDataFrame([], ENTRY)
    rows = spark.read.schema(f"{KINDS['tier_list']}, _broken STRING").option("columnNameOfCorruptRecord", "_broken").json(paths)
    build = F.regexp_extract(F.col("_metadata.file_path"), "/builds/([0-9a-f]+)/", 1)
    whole = rows.select("envelope.*", build.alias("build"), "_broken").where("_broken IS NULL AND patch IS NOT NULL")
    return manifest(whole.select(*(c.split()[0] for c in ENTRY.split(", "))))


def prune_builds(spark: SparkSession, root: str, keep: int = 2) -> list[str]:
    """Removes the builds that none of the last ``keep`` manifests names, and the manifests before those; the builds removed."""
    numbers = manifest_numbers(spark, root)
    named = {r.build for n in numbers[-keep:] for r in read_manifest(spark, root, n).select("build").collect()}
    gone = [f for f in shared.folders(spark, f"{root}/builds/*") if f.rsplit("/", 1)[1] not in named]
    for folder in [*gone, *(f"{root}/manifests/{n:08d}" for n in numbers[:-keep])]:
        shared.remove(spark, folder)
    return [f.rsplit("/", 1)[1] for f in gone]


def manifest(entries: DataFrame) -> DataFrame:
    """One row for each partition, the latest written; newest patches first."""
    last = Window.partitionBy(*PARTITION).orderBy(F.col("built_at").desc())
    rows = entries.withColumn("_n", F.row_number().over(last)).where("_n = 1").drop("_n")
    return sort_partitions(rows)


def merge_manifest(known: DataFrame, found: DataFrame, new: DataFrame) -> DataFrame:
    """Known entries, those found in the tree, and the new one, which counts before the known and these before the found."""
    ranked = [(new, 0), (known, 1), (found, 2)]
    rows = None
    for df, rank in ranked:
        df = df.withColumn("_rank", F.lit(rank))
        rows = df if rows is None else rows.unionByName(df, allowMissingColumns=True)
    first = Window.partitionBy(*PARTITION).orderBy("_rank")
    merged = rows.withColumn("_n", F.row_number().over(first)).where("_n = 1").drop("_n", "_rank")
    if "source" in merged.columns:
        merged = one_source(merged)
    return sort_partitions(merged)


def one_source(rows: DataFrame) -> DataFrame:
    """Fails when a tree mixes sources."""
    whole = Window.partitionBy()  # a row for each partition of the tree
    mixed = F.min("source").over(whole) == F.max("source").over(whole)
    return rows.withColumn("_same", mixed).where(F.assert_true(F.coalesce("_same", F.lit(True)), F.lit("a tree holds one source")).isNull()).drop("_same")


def patch_numbers(column: str = "patch"):
    return F.transform(F.split(column, r"\."), lambda x: x.try_cast("int"))


def sort_partitions(rows: DataFrame) -> DataFrame:
    return rows.orderBy(patch_numbers().desc(), "region", "queue", "bracket")


def latest_partition(rows: DataFrame, built: DataFrame) -> DataFrame:
    """One row: the partition of the newest patch; of several, the one just built."""
    mine = built.select(*PARTITION, F.lit(1).alias("mine"))
    return rows.join(mine, PARTITION, "left").orderBy(patch_numbers().desc(), F.col("mine").desc_nulls_last(), "region", "queue", "bracket").limit(1).drop("mine")


def archive_rows(rows: DataFrame) -> DataFrame:
    """Rows as the archive stores them: hashed payload, clamped numbers, and the day they were fetched."""
    clamp = lambda c: F.greatest(F.lit(-(2**31)), F.least(F.lit(2**31 - 1), F.col(c))).cast("int")
    return rows.withColumns({
        "queue_id": clamp("queue_id"), "game_duration_s": clamp("game_duration_s"), "payload_sha256": F.sha2("payload", 256), "dt": F.to_date("fetched_at"),
    })


def append_archive(rows: DataFrame, root: str, source: str, name: str | None = None) -> None:
    """Appends rows as new parts of their days.

    With a ``name`` the parts go to a folder of that name in each day: they are written aside and moved when all are there, and what an
    earlier append left under that name is replaced. So an append of a name can be tried again.
    """
    spark, out = rows.sparkSession, archive_rows(rows).write.partitionBy("dt").option("maxRecordsPerFile", PART_ROWS).option("compression", "zstd")
    if name is None:
        out.mode("append").parquet(f"{root}/{source}")
        return
    aside = f"{root}/_staged/{source}/{name}"
    out.mode("overwrite").parquet(aside)
    for old in shared.folders(spark, f"{root}/{source}/dt=*/{name}"):
        shared.remove(spark, old)
    for day in shared.folders(spark, f"{aside}/dt=*"):
        shared.move(spark, day, f"{root}/{source}/{day.rsplit('/', 1)[1]}/{name}")
    shared.remove(spark, aside)
