"""Registration of a query together with its SQL counterpart."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from lendgrid.catalog.views import with_views

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def register(name: str, sql: str | None = None, views: tuple[str, ...] = (), exact: tuple[str, ...] = (),
             rounded: tuple[str, ...] = (), digits: int = 6):
    """Register ``run(spark, folder)``; both sides return ``exact`` columns and ``rounded`` doubles.

    Doubles are rounded because sums add up in another order on each engine. A
    small step off the half-way points keeps the last bit from deciding there.
    """

    step = 0.03 / 10**digits

    def keep(run):
        def query(spark: SparkSession, folder: str) -> DataFrame:
            df = run(spark, folder)
            if not exact and not rounded:
                return df
            doubles = [(F.round(F.col(f"`{c}`").cast("double") + F.lit(step), digits) + F.lit(0.0)).alias(c) for c in rounded]
            return df.select(*[F.col(f"`{c}`") for c in exact], *doubles)

        query.__name__ = name
        query.__doc__ = run.__doc__
        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")
        QUERIES[name] = query
        if sql is not None:
            columns = [f'"{c}"' for c in exact]
            columns += [f'round(CAST("{c}" AS DOUBLE) + {step}::DOUBLE, {digits}) + 0.0 AS "{c}"' for c in rounded]
            SQL[name] = f"{with_views(views)}SELECT {', '.join(columns) or '*'} FROM ({sql}) AS result"
        return run

    return keep
