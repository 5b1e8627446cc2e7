"""Catalogue preparation queries: lists, defaults, lookups, snapshots, latest rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from cadenza.functions.features import loudness_norm, tempo_norm, unit_clamp
from cadenza.functions.values import first_or_unknown, joined_names, leading_two, parse_list_field
from cadenza.operators import feeds
from cadenza.operators.latest import latest_per_key, newest_run
from cadenza.operators.lookup import lookup_join
from cadenza.operators.search import search_documents
from cadenza.session import scratch_folder
from cadenza.sinks.tables import to_messages
from cadenza.sources import catalogue as cat
from cadenza.sources.snapshots import index_path, read_snapshots, write_runs
from cadenza.sources.tables import listening, songs, table
from cadenza.suite.registry import query, r9


@query(
    "list_parse",
    """SELECT c_custkey, 2::BIGINT AS n_pair, c_name AS first_of_pair, c_name || ', ' || c_mktsegment AS shown_pair,
              c_name || '''s band' AS quoted, c_mktsegment AS bare, 0::BIGINT AS n_empty, 'Unknown' AS first_of_empty
       FROM customer""",
)
def list_parse(spark, sf_dir):
    """List literals in every spelling, built from customers."""
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment")
    pair = parse_list_field(F.concat(F.lit("['"), "c_name", F.lit("', '"), "c_mktsegment", F.lit("']")))
    quoted = parse_list_field(F.concat(F.lit('["'), "c_name", F.lit("'s band\"]")))
    empty = parse_list_field(F.lit("[]"))
    return c.select(
        "c_custkey",
        F.size(leading_two(pair)).cast("bigint").alias("n_pair"),
        first_or_unknown(pair).alias("first_of_pair"),
        joined_names(pair).alias("shown_pair"),
        first_or_unknown(quoted).alias("quoted"),
        first_or_unknown(parse_list_field(F.col("c_mktsegment"))).alias("bare"),
        F.size(empty).cast("bigint").alias("n_empty"),
        first_or_unknown(empty).alias("first_of_empty"),
    )


@query(
    "clamp_norm",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
              round(CASE WHEN x IS NOT NULL THEN greatest(0.0, least(x, 1.0)) END, 9) + 0.0 AS clamped,
              round(greatest(0.0, least((loudness + 60) / 60, 1.0)), 9) + 0.0 AS loudness_norm,
              round(greatest(0.0, least(tempo / 250, 1.0)), 9) + 0.0 AS tempo_norm
       FROM (SELECT *, nullif(l_discount, 0.05) * 12 - 0.1 AS x, l_extendedprice / 1000 - 80 AS loudness,
                    l_quantity * 8 AS tempo FROM lineitem)""",
)
def clamp_norm(spark, sf_dir):
    """Both ends of every clamp, and NULL kept as NULL."""
    lines = table(spark, sf_dir, "lineitem")
    x = F.nullif(F.col("l_discount"), F.lit(0.05)) * 12 - 0.1
    return lines.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        r9(unit_clamp(x)).alias("clamped"),
        r9(loudness_norm(F.col("l_extendedprice") / 1000 - 80)).alias("loudness_norm"),
        r9(tempo_norm(F.col("l_quantity") * 8)).alias("tempo_norm"),
    )


def _supplier_artists(spark, sf_dir):
    """Suppliers as artists: one name per nation in capitals, so names repeat and miss."""
    s = table(spark, sf_dir, "supplier")
    nation = F.col("s_nationkey").cast("string")
    return s.select(
        F.concat(F.lit("BRAND#"), nation).alias("name"),
        F.col("s_suppkey").alias("followers"),
        F.floor("s_acctbal").alias("popularity"),
        F.concat(F.lit("['N"), nation, F.lit("', 'Pop']")).alias("genres"),
        F.concat(F.lit("GENRE_"), nation).alias("main_genre"),
        F.col("s_suppkey").alias("place"),
    )


@query(
    "artist_lookup",
    """WITH artists AS (
           SELECT lower('BRAND#' || s_nationkey) AS k, s_suppkey, floor(s_acctbal)::BIGINT AS pop, s_nationkey
           FROM supplier QUALIFY row_number() OVER (PARTITION BY s_nationkey ORDER BY s_suppkey DESC) = 1)
       SELECT p_partkey AS song_id, p_brand AS primary_artist, coalesce(s_suppkey, 0) AS artist_followers,
              coalesce(pop, 0) AS artist_popularity, coalesce('GENRE_' || s_nationkey, 'Unknown') AS main_genre,
              coalesce('N' || s_nationkey || '|Pop', '') AS genres
       FROM part LEFT JOIN artists ON k = lower(p_brand)""",
)
def artist_lookup(spark, sf_dir):
    """Last artist of a name wins, misses get defaults."""
    parts = table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("song_id"), F.col("p_brand").alias("primary_artist")
    )
    found = cat.with_artists(parts, _supplier_artists(spark, sf_dir), spread_by=["song_id"])
    return found.withColumn("genres", F.array_join("genres", "|"))


@query(
    "hot_key_lookup",
    """WITH t AS (SELECT event_type, max(user_id) AS top_user, count(*) AS n FROM events
                  WHERE event_type <> 'error' GROUP BY event_type)
       SELECT event_id, event_type, top_user, n FROM events LEFT JOIN t USING (event_type)""",
)
def hot_key_lookup(spark, sf_dir):
    """J1 beyond the broadcast bound: every key is hot and cut into pieces."""
    events = table(spark, sf_dir, "events").select("event_id", "event_type", "user_id")
    per_type = events.filter(F.col("event_type") != "error").groupBy("event_type").agg(
        F.max("user_id").alias("top_user"), F.count("*").alias("n")
    )
    return lookup_join(
        events.select("event_id", "event_type"), per_type, "event_type",
        spread_by=["event_id"], broadcast=False, rows_per_piece=100,
    )


_TRACKS_SQL = """
    ev AS (SELECT *, CAST(json_extract_string(props, '$.k') AS BIGINT) AS song_id FROM events),
    track AS (SELECT song_id, count(*) AS playcount, count(DISTINCT user_id) AS listeners,
                     string_agg(DISTINCT CASE WHEN value > 300 THEN event_type END, '|' ORDER BY CASE WHEN value > 300 THEN event_type END) AS tags
              FROM ev GROUP BY song_id),
    artist AS (SELECT p_brand, string_agg(DISTINCT lower(p_type), '|' ORDER BY lower(p_type)) AS tags FROM part GROUP BY p_brand),
    enriched AS (
        SELECT p_partkey AS song_id, part.p_brand AS artist, coalesce(playcount, 0) AS lastfm_playcount,
               coalesce(listeners, 0) AS lastfm_listeners, coalesce(track.tags, artist.tags, '') AS lastfm_tags,
               CASE WHEN track.tags IS NOT NULL THEN 'enriched' WHEN track.song_id IS NOT NULL THEN 'fallback'
                    ELSE 'not_found' END AS outcome
        FROM part LEFT JOIN track ON track.song_id = p_partkey LEFT JOIN artist ON artist.p_brand = part.p_brand)"""


def _enriched(spark, sf_dir):
    parts = songs(table(spark, sf_dir, "part"))
    events = listening(table(spark, sf_dir, "events"))
    loud = F.when(F.col("value") > 300, F.upper("event_type"))
    tags = F.transform(F.array_sort(F.collect_set(loud)), lambda t: F.struct(t.alias("name")))
    track = events.groupBy("song_id").agg(
        F.to_json(
            F.struct(
                F.count("*").cast("string").alias("playcount"),
                F.count_distinct("user_id").cast("string").alias("listeners"),
                F.struct(tags.alias("tag")).alias("toptags"),
            )
        ).alias("info")
    )
    artist = parts.groupBy("artist").agg(
        F.array_sort(F.collect_set(F.lower("main_genre"))).alias("artist_tags"),
        F.array().cast("array<string>").alias("similar_artists"),
    )
    return cat.enrich(parts.select("song_id", "title", "artist"), track, artist)


@query(
    "tag_enrichment",
    f"""WITH {_TRACKS_SQL} SELECT * FROM enriched""",
)
def tag_enrichment(spark, sf_dir):
    """Counters and tags from JSON, artist tags as the fallback."""
    return _enriched(spark, sf_dir).select(
        "song_id", "artist", "lastfm_playcount", "lastfm_listeners",
        F.array_join("lastfm_tags", "|").alias("lastfm_tags"), "outcome",
    )


@query(
    "enrichment_outcomes",
    f"""WITH {_TRACKS_SQL} SELECT outcome, count(*) AS n FROM enriched GROUP BY outcome""",
)
def enrichment_outcomes(spark, sf_dir):
    """Songs per enrichment outcome."""
    return feeds.outcome_counts(_enriched(spark, sf_dir), F.col("outcome"))


@query(
    "union_shapes",
    """SELECT source, count(*) AS n, count(energy) AS n_energy, count(lastfm_playcount) AS n_playcount FROM (
           SELECT 'kaggle_songs_csv' AS source, p_size / 50.0 AS energy, NULL AS lastfm_playcount FROM part
           UNION ALL SELECT 'lastfm_enrichment', NULL, 1 FROM part) GROUP BY source""",
)
def union_shapes(spark, sf_dir):
    """Catalogue and enrichment messages in one frame."""
    catalogue = songs(table(spark, sf_dir, "part")).withColumn("source", F.lit(cat.CATALOGUE_SOURCE))
    both = cat.union_shapes(catalogue, _enriched(spark, sf_dir))
    return both.groupBy("source").agg(
        F.count("*").alias("n"), F.count("energy").alias("n_energy"),
        F.count("lastfm_playcount").alias("n_playcount"),
    )


@query(
    "snapshot_union",
    """SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority FROM orders""",
)
def snapshot_union(spark, sf_dir):
    """Monthly snapshots written, listed by the index and read back."""
    orders = table(spark, sf_dir, "orders")
    root = scratch_folder(spark, "snapshots")
    write_runs(orders.withColumn("run_id", F.date_format("o_orderdate", "yyyyMM")), root)
    return read_snapshots(spark, index_path(root), schema=orders.schema)


@query(
    "snapshot_history",
    """SELECT strftime(o_orderdate, '%Y%m') AS run_id, count(*) AS record_count FROM orders GROUP BY ALL""",
)
def snapshot_history(spark, sf_dir):
    """One history entry per snapshot with its record count."""
    orders = table(spark, sf_dir, "orders")
    root = scratch_folder(spark, "history")
    write_runs(orders.withColumn("run_id", F.date_format("o_orderdate", "yyyyMM")), root)
    return spark.read.json(f"{root}/history").select("run_id", "record_count")


@query(
    "dedup_latest",
    """SELECT user_id, event_type, event_id, ts, value FROM events
       QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) = 1""",
)
def dedup_latest(spark, sf_dir):
    """The newest event per user and type."""
    events = table(spark, sf_dir, "events").select("user_id", "event_type", "event_id", "ts", "value")
    return latest_per_key(events, ["user_id", "event_type"], ["ts", "event_id"])


@query(
    "newest_run",
    """SELECT o_orderkey, o_custkey, o_totalprice, strftime(o_orderdate, '%Y%m') AS run_id FROM orders
       WHERE strftime(o_orderdate, '%Y%m') = (SELECT max(strftime(o_orderdate, '%Y%m')) FROM orders)""",
)
def newest_run_rows(spark, sf_dir):
    """Rows of the newest monthly run."""
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_totalprice", F.date_format("o_orderdate", "yyyyMM").alias("run_id")
    )
    return newest_run(orders)


@query(
    "catalogue_messages",
    """SELECT CAST(p_partkey AS VARCHAR) AS "key", p_name AS title, p_brand AS artist, p_size / 50.0 AS energy FROM part""",
)
def catalogue_messages(spark, sf_dir):
    """K2/K9/F2: keyed JSON messages, read back by the declared schema."""
    messages = to_messages(songs(table(spark, sf_dir, "part")), F.col("song_id"))
    return messages.select(
        "key", F.from_json("value", "title string, artist string, energy double").alias("d")
    ).select("key", "d.*")


@query(
    "search_documents",
    """SELECT CAST(doc_id AS VARCHAR) AS song_id, source AS title, source AS primary_artist, 2::BIGINT AS n_artists,
              md5(text) AS lyrics_md5, lang AS genre, 0::BIGINT AS n_niche, n_chars AS popularity, 1999::BIGINT AS "year"
       FROM documents""",
)
def search_document_rows(spark, sf_dir):
    """Search documents built from raw text columns."""
    d = table(spark, sf_dir, "documents")
    raw = d.select(
        F.col("doc_id").cast("string").alias("id"),
        F.col("source").alias("name"),
        F.concat(F.lit("['"), "source", F.lit("', '"), "lang", F.lit("']")).alias("artists"),
        F.col("text").alias("lyrics"),
        F.col("lang").alias("genre"),
        F.lit(None).cast("string").alias("niche_genres"),
        F.concat(F.col("n_chars").cast("string"), F.lit(".7")).alias("popularity"),
        F.lit("1999").alias("year"),
    )
    return search_documents(raw).select(
        "song_id", "title", "primary_artist", F.size("artists").cast("bigint").alias("n_artists"),
        F.md5("lyrics").alias("lyrics_md5"), "genre",
        F.size("niche_genres").cast("bigint").alias("n_niche"),
        F.col("popularity").cast("bigint").alias("popularity"),
        F.col("year").cast("bigint").alias("year"),
    )
