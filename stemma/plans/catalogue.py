"""Every registered query of the package with its DuckDB twin."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from stemma.plans import composed, loads, maintenance, profiles, shared_sql, upkeep

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "author_profile": profiles.author_profile_query,
    **composed.QUERIES,
    **shared_sql.QUERIES,
    **upkeep.QUERIES,
    **maintenance.QUERIES,
    **loads.QUERIES,
}

ORACLES: dict[str, str] = {"author_profile": profiles.PROFILE_SQL, **composed.ORACLES, **shared_sql.ORACLES, **upkeep.ORACLES, **maintenance.ORACLES, **loads.ORACLES}
