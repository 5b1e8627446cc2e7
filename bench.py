"""Time the headline queries and print one JSON line.

``BENCH_SF_DIR`` names the tables, ``BENCH_CPUS`` the local cores. Every query is run to its
last row into the no-op sink: once to warm up, then once timed.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

from cadenza.session import build_session
from cadenza.suite import REGISTRY

HEADLINE = (
    "mood_by_key", "mood_by_artist", "global_mood", "trending_songs", "bot_suspicion", "recent_feed",
    "dedup_latest", "clamp_norm", "artist_lookup", "hot_key_lookup", "tag_enrichment", "pk_fk_audit",
    "normalised_songs", "nearest_centroid_songs", "nearest_centroid", "cluster_top_genres",
    "profile_signals", "kmeans_sweep", "bm25_match", "phrase_match", "fuzzy_match", "facet_terms",
    "snapshot_union", "stream_mood", "stream_trending", "stream_classify", "kmeans_measures", "lyrics_sentiment",
    "recommend_given", "stream_search",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
    spark = build_session(
        "cadenza-bench",
        f"local[{cpus}]",
        spark__sql__shuffle__partitions=cpus,
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
        spark__driver__memory=os.environ.get("BENCH_MEMORY", "12g"),
    )
    spark.sparkContext.setLogLevel("ERROR")

    def seconds(name: str) -> float:
        start = time.perf_counter()
        REGISTRY[name].run(spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    timings = {}
    for name in sys.argv[1:] or HEADLINE:
        seconds(name)
        timings[name] = round(seconds(name), 3)
    spark.stop()
    total = round(sum(timings.values()), 3)
    print(json.dumps({
        "metric": "headline_queries_total", "value": total, "unit": "sec", "queries": timings,
        "sf": Path(sf_dir).name.removeprefix("sf"), "cpus": int(cpus),
    }))


if __name__ == "__main__":
    main()
