"""Every query of the engine with its oracle SQL."""

from __future__ import annotations

from collections.abc import Callable

from fringelake.plans.fixtures import Fixtures, oracle

FLAGSHIP = "ifg_evidence_score"
QUERIES: dict[str, Callable] = {}
ORACLE_SQL: dict[str, str] = {}


def query(name: str, needs: str = "", sql: str | None = None):
    """Registers a function of (fixtures, spark) as a query of (spark, sf_dir), with its oracle SQL over the fixtures in `needs`."""

    def keep(function):
        def run(spark, sf_dir):
            return function(Fixtures(spark, sf_dir), spark)

        if name in QUERIES:
            raise ValueError(f"two queries are named {name}")
        run.__name__, run.__doc__ = name, function.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLE_SQL[name] = oracle(needs, sql)
        return function

    return keep


from fringelake.plans import form_queries, point_queries, quality_queries, selection_queries, series_queries  # noqa: E402, F401
