"""Every operator and model as a named query over the test tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]


def all_queries() -> dict[str, Query]:
    from ridelake.queries import ingest, models, operators, reports, streams

    found: dict[str, Query] = {}
    for module in (models, operators, ingest, streams, reports):
        found.update(module.QUERIES)
    return {name: comparable(query) for name, query in found.items()}


def comparable(query: Query) -> Query:
    """The query with its result in a form both engines print alike: doubles with six
    decimals, instants without zone, audit columns left out."""
    from pyspark.sql import types as T

    from ridelake.session import configure

    audit = {"loaded_at", "created_at"}

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        result = query(configure(spark), sf_dir)
        columns = []
        for field in result.schema:
            name, kind = field.name, field.dataType
            instant = isinstance(kind, (T.TimestampType, T.TimestampNTZType))
            if name in audit and instant:
                continue
            if isinstance(kind, T.DoubleType):
                columns.append(f"round({name}, 6) AS {name}")
            elif instant:
                columns.append(f"cast({name} AS timestamp_ntz) AS {name}")
            elif isinstance(kind, T.IntegerType):
                columns.append(f"cast({name} AS bigint) AS {name}")
            else:
                columns.append(name)
        return result.selectExpr(*columns)

    return run
