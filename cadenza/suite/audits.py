"""Integrity and facet queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from cadenza.operators import feeds
from cadenza.operators.audit import audit, duplicate_keys, orphan_keys
from cadenza.sources.tables import table
from cadenza.suite.registry import query


@query(
    "pk_fk_audit",
    """SELECT 'orders' AS table_name, 'unique(o_orderkey)' AS check_name,
              (SELECT count(*) FROM (SELECT o_orderkey FROM orders GROUP BY 1 HAVING count(*) > 1)) AS n_findings
       UNION ALL SELECT 'orders', 'foreign_key(o_custkey)', (SELECT count(*) FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer))
       UNION ALL SELECT 'orders', 'not_null(o_orderkey)', (SELECT count(*) FROM orders WHERE o_orderkey IS NULL)
       UNION ALL SELECT 'orders', 'not_null(o_custkey)', (SELECT count(*) FROM orders WHERE o_custkey IS NULL)
       UNION ALL SELECT 'lineitem', 'unique(l_orderkey,l_linenumber)',
              (SELECT count(*) FROM (SELECT 1 FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1))
       UNION ALL SELECT 'lineitem', 'foreign_key(l_orderkey)', (SELECT count(*) FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders))
       UNION ALL SELECT 'lineitem', 'foreign_key(l_partkey)', (SELECT count(*) FROM lineitem WHERE l_partkey NOT IN (SELECT p_partkey FROM part))
       UNION ALL SELECT 'lineitem', 'not_null(l_orderkey)', (SELECT count(*) FROM lineitem WHERE l_orderkey IS NULL)""",
)
def pk_fk_audit(spark, sf_dir):
    """Z3: keys, references and required columns of orders and lineitem."""
    orders, lines = table(spark, sf_dir, "orders"), table(spark, sf_dir, "lineitem")
    customers, parts = table(spark, sf_dir, "customer"), table(spark, sf_dir, "part")
    first = audit(orders, "orders", ["o_orderkey"], ["o_orderkey", "o_custkey"],
                  [("o_custkey", customers, "c_custkey")])
    second = audit(lines, "lineitem", ["l_orderkey", "l_linenumber"], ["l_orderkey"],
                   [("l_orderkey", orders, "o_orderkey"), ("l_partkey", parts, "p_partkey")])
    return first.unionByName(second)


@query(
    "duplicate_keys",
    """SELECT l_orderkey, l_linenumber, count(*) AS n_rows FROM lineitem GROUP BY ALL HAVING count(*) > 1""",
)
def duplicate_key_rows(spark, sf_dir):
    """Z3: repeated (order, line) pairs."""
    return duplicate_keys(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


@query(
    "orphan_keys",
    """SELECT user_id, count(*) AS n_rows FROM events
       WHERE user_id NOT IN (SELECT s_suppkey FROM supplier) GROUP BY user_id""",
)
def orphan_key_rows(spark, sf_dir):
    """Z3: users that are no supplier, with their number of events."""
    return orphan_keys(table(spark, sf_dir, "events"), "user_id", table(spark, sf_dir, "supplier"), "s_suppkey")


@query(
    "facet_terms",
    """SELECT * FROM (SELECT lang, count(*) AS n FROM documents WHERE lang IS NOT NULL GROUP BY lang
                      ORDER BY n DESC, lang LIMIT 100) WHERE lang <> ''""",
)
def facet_terms(spark, sf_dir):
    """The most frequent genres (languages here)."""
    return feeds.facet(table(spark, sf_dir, "documents"), "lang")


@query("distinct_artists", "SELECT DISTINCT p_brand AS artist FROM part")
def distinct_artists(spark, sf_dir):
    """All artists in order."""
    return feeds.distinct_sorted(table(spark, sf_dir, "part").select(F.col("p_brand").alias("artist")), "artist")


@query(
    "row_counts",
    """SELECT count(*) AS n_raw, count(DISTINCT user_id) AS n_users, count(*) FILTER (event_type = 'view') AS n_plays FROM events""",
)
def row_counts(spark, sf_dir):
    """A10: several counts in one pass."""
    return table(spark, sf_dir, "events").agg(
        F.count("*").alias("n_raw"), F.count_distinct("user_id").alias("n_users"),
        F.count_if(F.col("event_type") == "view").alias("n_plays"),
    )
