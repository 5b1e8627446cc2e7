"""Streaming jobs: detectors, scoring, indexing, snapshots.

Each job takes a parsed stream and a checkpoint folder and returns the started query. A
trigger is ``None`` for "all that is there, then stop", or an interval such as "30 seconds".
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from cadenza.functions.features import FEATURES
from cadenza.functions.text import Analyzer, tokens
from cadenza.llm.common import hinted, settle
from cadenza.operators.genres import mood_gap
from cadenza.operators.latest import latest_per_key, newest_run
from cadenza.operators.scoring import collect_centroids, score_songs, unscored_songs
from cadenza.operators.search import FieldIndex, analysed_documents, indexable, words_of
from cadenza.sinks.tables import FREED_SHUFFLES, settings
from cadenza.sinks.upsert import BATCH, KeyedTable, Sink, fan_out, unique_by
from cadenza.sources.messages import json_objects
from cadenza.sources.snapshots import export_index, is_recorded, record_snapshot, snapshot_path


def run(stream: DataFrame, checkpoint: str, sink: Sink, mode: str, every: str | None = None) -> StreamingQuery:
    """Start a query that hands each micro-batch to ``sink``."""
    writer = stream.writeStream.outputMode(mode).option("checkpointLocation", checkpoint)
    trigger = {"processingTime": every} if every else {"availableNow": True}
    return writer.foreachBatch(sink).trigger(**trigger).start()


def upsert_windows(windows: DataFrame, checkpoint: str, *tables: KeyedTable,
                   also: Sink | None = None, every: str | None = None) -> StreamingQuery:
    """Changed windows of each trigger into one or more keyed tables."""
    sinks: list[Sink] = [t.write for t in tables]
    if also:
        sinks.append(also)
    return run(windows, checkpoint, fan_out(*sinks), "update", every)


def classify(songs: DataFrame, checkpoint: str, table: KeyedTable,
             signals: Callable[[SparkSession], DataFrame], every: str | None = None,
             order: Sequence[str] = ()) -> StreamingQuery:
    """Score songs against the newest centroids, looked up again for each batch.

    ``signals`` returns parsed profile messages. ``order`` are the songs' columns of arrival:
    of two requests for a song in one batch the last is answered.
    """

    def score(rows: DataFrame, batch_id: int) -> None:
        profiles = signals(rows.sparkSession).filter(F.col("signal_type") == "cluster_profile")
        newest = latest_per_key(newest_run(profiles, order=("produced_at_utc",)), ["cluster_id"], ["produced_at_utc"])
        values = F.array(*[F.col(f"centroid_features.{f}") for f in FEATURES])
        centroids = collect_centroids(newest, values)
        asked = unique_by(["song_id"], order)(rows) if order else rows
        scored = score_songs(asked, centroids) if centroids else unscored_songs(asked)
        with settings(rows.sparkSession, FREED_SHUFFLES):
            table.write(unique_by(["song_id"])(scored), batch_id)

    return run(songs, checkpoint, score, "append", every)


def index_documents(messages: DataFrame, checkpoint: str, documents: KeyedTable, occurrences: KeyedTable,
                    rejects_path: str, text: str, analyzer: Analyzer, every: str | None = None,
                    order: Sequence[str] = ()) -> StreamingQuery:
    """K6: upsert documents and their words; messages without an id go to a reject table.

    Writes are idempotent per batch and the checkpoint advances only after them. ``order``
    are the messages' columns of arrival; the last version of a document in a batch wins.
    """

    def index(rows: DataFrame, batch_id: int) -> None:
        documents.write(unique_by(["doc_id"], order)(indexable(rows)), batch_id)
        # Read back, so that the versions are not chosen a second time for their words.
        valid = documents.batch(rows.sparkSession, batch_id)
        occurrences.write(words_of(analysed_documents(valid, "doc_id", text, analyzer)), batch_id)
        ids = [F.coalesce(F.col(c), F.lit("")) == "" for c in ("song_id", "songId") if c in rows.columns]
        missing = ids[0] if len(ids) == 1 else ids[0] & ids[1]
        rows.filter(missing).write.mode("overwrite").parquet(f"{rejects_path}/{BATCH}={batch_id}")

    return run(messages, checkpoint, index, "append", every)


def live_occurrences(spark: SparkSession, documents: KeyedTable, occurrences: KeyedTable) -> DataFrame:
    """Words of each document's last revision only.

    Only documents with several revisions are looked up; where there are none, no word is
    shuffled. Batches whose documents are not written yet do not count.
    """
    revisions = documents.history(spark)
    of_document = revisions.groupBy("doc_id").agg(F.min(BATCH).alias("first"), F.max(BATCH).alias("last"))
    revised = settle(of_document.filter("last > first").select("doc_id", "last"), "revised")
    live = occurrences.history(spark).join(F.broadcast(revisions.select(BATCH).distinct()), BATCH, "left_semi")
    if not revised.isEmpty():
        live = live.join(hinted(revised), "doc_id", "left").filter(F.coalesce(F.col("last") == F.col(BATCH), F.lit(True))).drop("last")
    return live.drop(BATCH).select("term", "doc_id", "pos", "doc_len")


def index_changes(messages: DataFrame, checkpoint: str, documents: KeyedTable, occurrences: KeyedTable, changes: KeyedTable,
                  totals: KeyedTable, text: str, analyzer: Analyzer, every: str | None = None, order: Sequence[str] = ()) -> StreamingQuery:
    """K6: a searchable index kept up by signed changes.

    Beside documents and words each batch writes how it changes the corpus: +1 for each document
    with a term, -1 for each that held the term in the version it replaces, and the same for the
    number of documents and words. Document frequencies and the average length are sums of
    these, so no batch counts history again; only the replaced documents' last versions are read.
    """

    def index(rows: DataFrame, batch_id: int) -> None:
        spark = rows.sparkSession
        new = unique_by(["doc_id"], order)(indexable(rows)).persist()
        try:
            old = documents.before(spark, batch_id, new.schema, of=new.select("doc_id"))
            signed = new.select(text, F.lit(1).alias("sign")).unionByName(old.select(text, F.lit(-1).alias("sign")))
            words = signed.select("sign", tokens(F.col(text), analyzer).alias("tokens"))
            # A document's first term also stands for the document, so that texts are analysed once for all sums.
            names = F.array_distinct("tokens.term")
            terms = words.select("sign", F.size("tokens").alias("n"), F.posexplode_outer(names).alias("at", "term")).filter(F.col("term").isNotNull())
            first = F.when(F.col("at") == 0, F.col("sign"))
            summed = terms.groupBy("term").agg(F.sum("sign").alias("df"), F.sum(first).alias("n_docs"), F.sum(first * F.col("n")).alias("n_words"))
            summed = settle(summed, "changes")
            changes.write(summed.select("term", "df").filter("df <> 0"), batch_id)
            totals.write(summed.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("n_docs", "n_words")]), batch_id)
            occurrences.write(words_of(analysed_documents(new, "doc_id", text, analyzer)), batch_id)
            documents.write(new, batch_id)
        finally:
            new.unpersist()

    return run(messages, checkpoint, index, "append", every)


def live_index(spark: SparkSession, documents: KeyedTable, occurrences: KeyedTable, changes: KeyedTable, totals: KeyedTable,
               analyzer: Analyzer) -> FieldIndex:
    """The index that ``index_changes`` keeps up, ready for the search functions."""
    vocabulary = changes.history(spark).groupBy("term").agg(F.sum("df").alias("df")).filter("df > 0")
    summed = totals.history(spark).agg(F.sum("n_docs").alias("n_docs"), F.sum("n_words").alias("n_words"))
    stats = summed.select("n_docs", F.try_divide("n_words", "n_docs").alias("avg_len"))
    return FieldIndex(live_occurrences(spark, documents, occurrences), vocabulary, stats, analyzer)


def split_late(events: DataFrame, checkpoint: str, kept: KeyedTable, late: KeyedTable, delay: str, ts: str = "timestamp",
               every: str | None = None) -> StreamingQuery:
    """Rows behind the watermark go to a side table, as rows; all others to ``kept``.

    The watermark of a batch is the greatest time of all batches before it less ``delay``, so it
    follows from the data and not from the clock, and a batch that runs again splits the same way.
    Rows without a time are kept. The first batch has no late rows.
    """

    def split(rows: DataFrame, batch_id: int) -> None:
        spark = rows.sparkSession
        before = [t.before(spark, batch_id, rows.schema, all_rows=True).agg(F.max(ts).alias("t")) for t in (kept, late)]
        newest = before[0].unionByName(before[1]).agg(F.max("t")).first()[0]
        bound = F.lit(newest).cast("timestamp") - F.expr(f"INTERVAL {delay}")
        is_late = F.coalesce(F.col(ts) < bound, F.lit(False)) if newest is not None else F.lit(False)
        rows.persist()
        try:
            late.write(rows.filter(is_late), batch_id)
            kept.write(rows.filter(~is_late), batch_id)
        finally:
            rows.unpersist()

    return run(events, checkpoint, split, "append", every)


def follow_gap(live: DataFrame, checkpoint: str, table: KeyedTable, profile: Callable[[SparkSession], DataFrame],
               every: str | None = None) -> StreamingQuery:
    """Live mood windows against the genre profile that is newest when their batch runs.

    ``profile`` returns all versions of the profile (genre, expected_mood, version). A window that
    a later batch revises is compared again, with the profile of that batch.
    """

    def compare(rows: DataFrame, batch_id: int) -> None:
        versions = profile(rows.sparkSession)
        newest = versions.filter(F.col("version") == versions.agg(F.max("version")).scalar())
        table.write(mood_gap(rows, newest).withColumn("version", F.lit(versions.agg(F.max("version")).first()[0])), batch_id)

    return run(live, checkpoint, compare, "update", every)


def snapshot_topic(messages: DataFrame, checkpoint: str, root: str, run_id: str) -> StreamingQuery:
    """New messages to an immutable snapshot, then its history entry.

    The checkpoint is the committed offset. An empty batch leaves no snapshot. Batch ``n``
    is run ``<run_id>-<n>``; when it runs again after a failure, a run already in the history
    stays as it is, its index is exported again, and only an unrecorded leftover is replaced.
    """

    def snapshot(rows: DataFrame, batch_id: int) -> None:
        spark, run_n = rows.sparkSession, f"{run_id}-{batch_id}"
        if is_recorded(spark, root, run_n):
            export_index(spark, root)  # the failure may have come between entry and index
            return
        rows.persist()
        try:
            n = rows.count()
            if n:
                path = snapshot_path(root, run_n)
                rows.select("value").write.mode("overwrite").text(path)
                record_snapshot(spark, root, run_n, n, path)
        finally:
            rows.unpersist()

    return run(json_objects(messages), checkpoint, snapshot, "append")
