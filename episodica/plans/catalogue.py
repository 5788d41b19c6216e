"""Registry of queries: each a function of (spark, sf_dir), with its SQL where there is one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}

#: Common table expressions that the SQL of several queries begins with.
TRAJ = "traj AS (SELECT user_id AS ep, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS frame, event_type AS label, value, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, event_id, ts FROM events)"
VEC = "vec AS (SELECT vec_id, CAST(label AS BIGINT) AS ep, row_number() OVER (PARTITION BY label ORDER BY vec_id) - 1 AS frame, CAST(embedding AS DOUBLE[]) AS v FROM embeddings)"
DIMS = VEC + ", dims AS (SELECT vec_id, ep, frame, unnest(range(1, 65)) - 1 AS dim, unnest(v) AS x FROM vec)"


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        QUERIES[name] = f
        if sql:
            SQL[name] = sql
        return f

    return add
