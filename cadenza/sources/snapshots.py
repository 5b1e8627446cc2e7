"""Immutable snapshots and their history index."""

from __future__ import annotations

from urllib.parse import quote

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cadenza.operators.latest import first_per_key
from cadenza.schemas import SNAPSHOT_ENTRY, SONG_METADATA

DATASET = "song-metadata"


class SnapshotIndexError(RuntimeError):
    """The snapshot index is missing, empty, malformed or lists no snapshot."""


def snapshot_path(root: str, run_id: str) -> str:
    safe = quote(run_id, safe="").replace("~", "%7E").replace("%", "~")
    return f"{root.rstrip('/')}/snapshots/{DATASET}-{safe}.jsonl"


def folder_name(run: Column) -> Column:
    """A run id as a folder name that no file system changes: other characters as ~ and their code."""
    text = run.cast("string")
    name = F.url_encode(text)
    for char, code in (("%", "~"), ("+", "~20"), ("*", "~2A")):
        name = F.replace(name, F.lit(char), F.lit(code))
    return F.when(text.isNull(), "~null").when(text == "", "~empty").otherwise(name)


def entries_path(root: str) -> str:
    return f"{root.rstrip('/')}/history"


def index_path(root: str) -> str:
    """The one place of the exported index; Spark would skip a name that starts with ``_``."""
    return f"{root.rstrip('/')}/index.json"


def write_snapshot(rows: DataFrame, root: str, run_id: str) -> str:
    """K4: JSON lines of one run; an existing snapshot is never overwritten."""
    path = snapshot_path(root, run_id)
    rows.write.mode("errorifexists").json(path)
    return path


def record_snapshot(spark: SparkSession, root: str, run_id: str, record_count: int, path: str) -> None:
    """K5: append one history entry, then export the whole index as one document."""
    entry = spark.range(1).select(
        F.lit(run_id).alias("run_id"),
        F.current_timestamp().cast("string").alias("created_at_utc"),
        F.lit(record_count).cast("bigint").alias("record_count"),
        F.lit(path).alias("snapshot_path"),
    )
    entry.coalesce(1).write.mode("append").json(entries_path(root))
    export_index(spark, root)


def write_runs(rows: DataFrame, root: str, run: str = "run_id") -> None:
    """K4/K5: many runs at once (a backfill), one snapshot and one history entry per run.

    Rows without a run id are a run of their own, whose entry has a null id.
    """
    base = f"{root.rstrip('/')}/snapshots"
    # Rebalancing gives each run few files and still splits a run that holds most rows.
    rows.withColumn(run, folder_name(F.col(run))).hint("rebalance", run).write.partitionBy(run).mode("errorifexists").json(base)
    rows.groupBy(F.col(run).alias("run_id")).agg(F.count("*").alias("record_count")).select(
        "run_id",
        F.current_timestamp().cast("string").alias("created_at_utc"),
        "record_count",
        F.concat(F.lit(f"{base}/{run}="), folder_name(F.col("run_id"))).alias("snapshot_path"),
    ).write.mode("append").json(entries_path(root))
    export_index(rows.sparkSession, root)


def is_recorded(spark: SparkSession, root: str, run_id: str) -> bool:
    """True when the history already has the run; no history yet means no."""
    try:
        history = spark.read.schema(SNAPSHOT_ENTRY).json(entries_path(root))
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return False
    return bool(history.filter(F.col("run_id") == run_id).take(1))


def read_history(spark: SparkSession, root: str) -> DataFrame:
    """The history as a table, one row per run: its first entry."""
    entries = spark.read.schema(SNAPSHOT_ENTRY).json(entries_path(root))
    return first_per_key(entries, ["run_id"], ["created_at_utc", "snapshot_path"])


def export_index(spark: SparkSession, root: str) -> None:
    """One JSON object with the history in run order (one short entry per run)."""
    history = spark.read.schema(SNAPSHOT_ENTRY).json(entries_path(root))
    ordered = F.array_sort(
        F.collect_list(F.struct("created_at_utc", "run_id", "record_count", "snapshot_path"))
    )
    document = history.agg(ordered.alias("h")).select(
        F.to_json(
            F.struct(
                F.lit(DATASET).alias("dataset"),
                F.current_timestamp().cast("string").alias("updated_at_utc"),
                F.transform(
                    "h",
                    lambda e: F.struct(
                        e["run_id"].alias("run_id"),
                        e["created_at_utc"].alias("created_at_utc"),
                        e["record_count"].alias("record_count"),
                        e["snapshot_path"].alias("snapshot_path"),
                    ),
                ).alias("history"),
            )
        ).alias("value")
    )
    document.coalesce(1).write.mode("overwrite").text(index_path(root))


def read_index(spark: SparkSession, path: str) -> DataFrame:
    """The index as one variant column; missing, empty or non-object is an error."""
    try:
        text = spark.read.text(path, wholetext=True)
    except AnalysisException as error:
        raise SnapshotIndexError(f"no index at {path}") from error
    parsed = text.filter(F.trim("value") != "").select(F.try_parse_json("value").alias("index"))
    kinds = parsed.select(F.schema_of_variant("index").alias("kind")).take(2)
    if not kinds:
        raise SnapshotIndexError(f"empty index at {path}")
    if len(kinds) > 1 or not (kinds[0]["kind"] or "").startswith("OBJECT"):
        raise SnapshotIndexError(f"index at {path} is not one JSON object")
    return parsed


def listed_paths(index: DataFrame, base: str = "") -> DataFrame:
    """Snapshot paths in order of first mention.

    Entries that are no object or have no text path are skipped; a path without a scheme
    gets ``base`` in front.
    """
    history = F.try_variant_get("index", "$.history", "array<variant>")
    path = F.trim(F.try_variant_get("entry", "$.snapshot_path", "string"))
    kind = F.schema_of_variant(F.try_variant_get("entry", "$.snapshot_path", "variant"))
    full = path
    if base:
        joined = F.concat(F.lit(base.rstrip("/") + "/"), F.ltrim(path, F.lit("/")))
        full = F.when(path.rlike("^[a-zA-Z][a-zA-Z0-9+.-]*://"), path).otherwise(joined)
    listed = (
        index.select(F.posexplode(history).alias("place", "entry"))
        .filter((kind == "STRING") & (path != ""))
        .select("place", full.alias("path"))
    )
    return first_per_key(listed, ["path"], ["place"])


def read_snapshots(spark: SparkSession, path: str, base: str = "", schema: str = SONG_METADATA) -> DataFrame:
    """All listed snapshots as one bag of rows. Only the path list is collected."""
    rows = listed_paths(read_index(spark, path), base).orderBy("place").collect()
    if not rows:
        raise SnapshotIndexError(f"index at {path} lists no snapshots")
    return spark.read.schema(schema).json([r["path"] for r in rows])
