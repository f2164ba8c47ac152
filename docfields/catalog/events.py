"""Queries on the event log: counters, pacing, circuit state."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docfields import fixtures
from docfields.catalog import Catalog
from docfields.operators import health

QUERIES = Catalog()


def calls(s, d) -> DataFrame:
    return fixtures.outcomes(s, d).withColumn("at", health.seconds(F.col("ts"))).drop("ts", "name", "n")


CALLS = """calls AS (SELECT event_id, user_id AS key, event_type = 'error' AS failed, epoch_us(ts) / 1000000e0 AS sec FROM events)"""
PACED = f"""WITH {CALLS}, n AS (SELECT *, row_number() OVER (PARTITION BY {{by}} ORDER BY sec, event_id) AS n FROM calls)
  SELECT event_id, max(sec - (n - 1) * {{step}}) OVER (PARTITION BY {{by}} ORDER BY sec, event_id) + (n - 1) * {{step}} AS start_at FROM n"""

QUERIES.add("run_counters", "A11", lambda s, d: health.run_counters(fixtures.outcomes(s, d)),
            "SELECT event_type AS name, count(*) AS n FROM events GROUP BY event_type")
QUERIES.add("paced_calls", "W7", lambda s, d: health.pace(calls(s, d), "key", 12).select("event_id", "start_at"),
            PACED.format(by="key", step="5e0"))


def service_wide(s, d) -> DataFrame:
    """All calls share one service, so one key owns the whole table and is scanned in chunks."""
    return health.pace(calls(s, d).withColumn("service", F.lit("model")), "service", 0.5, hot_rows=1000).select("event_id", "start_at")


QUERIES.add("paced_service", "W7", service_wide, PACED.format(by="1", step="120e0"))

CIRCUIT = f"""WITH {CALLS},
g AS (SELECT *, sum(CASE WHEN failed THEN 0 ELSE 1 END) OVER w AS grp FROM calls WINDOW w AS (PARTITION BY {{by}} ORDER BY sec, event_id)),
r AS (SELECT *, CASE WHEN failed THEN sum(CASE WHEN failed THEN 1 ELSE 0 END) OVER (PARTITION BY {{by}}, grp ORDER BY sec, event_id) ELSE 0 END AS run FROM g),
o AS (SELECT *, max(CASE WHEN failed AND run % {{n}} = 0 THEN sec + {{open}} END) OVER (PARTITION BY {{by}} ORDER BY sec, event_id
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS open_until FROM r)
SELECT event_id, CAST(run AS bigint) AS run, open_until, coalesce(sec >= open_until, true) AS allowed FROM o"""


def states(s, d, by: str = "key", **how) -> DataFrame:
    log = calls(s, d).withColumn("service", F.lit("model"))
    return health.circuit(log, by, **how).select("event_id", F.col("run").cast("long").alias("run"), "open_until", "allowed")


QUERIES.add("circuit_states", "W8", lambda s, d: states(s, d, threshold=2, open_for=86400.0),
            CIRCUIT.format(by="key", n=2, open="86400e0"))
QUERIES.add("circuit_of_one_service", "W8", lambda s, d: states(s, d, "service", hot_rows=1000),
            CIRCUIT.format(by="1", n=5, open="60e0"))
