"""Newest rows, insert if absent, names."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.text import name_ascii, name_normalise
from ..operators.changes import get_or_insert, latest_by_name, latest_per_key
from .common import table


def insert_query(spark, d):
    """Minutes with an error are known; other events add the minutes that are not."""
    events = table(spark, d, "events").withColumn("name", F.date_format("ts", "yyyy-MM-dd HH:mm"))
    known = events.filter("event_type = 'error'").select("name", "event_id")
    return get_or_insert(known, events.filter("event_type <> 'error'").select("name", "event_id"), "name", "event_id")


def names_query(spark, d):
    users = table(spark, d, "customer").select(
        F.concat("c_name", F.lit("@"), F.col("c_mktsegment"), F.lit(".example.org")).alias("name"))
    plain = table(spark, d, "supplier").select(F.col("s_name").alias("name"))
    return users.unionByName(plain).select(
        "name", name_normalise(F.col("name")).alias("normal"), name_ascii(F.col("name")).alias("ascii"))


def _events(spark, d):
    return table(spark, d, "events")


QUERIES = {
    "latest_by_name": lambda s, d: latest_by_name(_events(s, d), "event_type", "purchase", "ts", "event_id"),
    "latest_per_key": lambda s, d: latest_per_key(_events(s, d), "user_id", "ts", "event_id"),
    "get_or_insert": insert_query,
    "name_normalise": names_query,
}

ORACLE = {
    "latest_by_name": """SELECT * FROM events WHERE event_type = 'purchase'
ORDER BY ts DESC, event_id DESC LIMIT 1""",
    "latest_per_key": """SELECT * FROM events
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1""",
    "get_or_insert": """WITH e AS (SELECT strftime(ts, '%Y-%m-%d %H:%M') AS name, event_id, event_type FROM events),
known AS (SELECT name, event_id FROM e WHERE event_type = 'error')
SELECT * FROM known UNION ALL
SELECT name, min(event_id) FROM e WHERE event_type <> 'error' AND name NOT IN (SELECT name FROM known) GROUP BY name""",
    "name_normalise": r"""WITH n AS (SELECT c_name || '@' || c_mktsegment || '.example.org' AS name FROM customer
UNION ALL SELECT s_name FROM supplier)
SELECT name, regexp_replace(regexp_replace(name, '@[^@]*$', ''), '[^\p{L}\p{N}_]+', '_', 'g') AS normal,
  regexp_replace(name, '[^A-Za-z0-9]', '_', 'g') AS ascii FROM n""",
}
