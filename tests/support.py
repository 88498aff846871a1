"""Small helpers shared by the tests."""

from __future__ import annotations

from medalstar import schemas

DEFAULTS = {"bigint": 0, "string": "", "boolean": False}


def rows_of(df, *columns):
    """Sorted tuples of the chosen columns (all by default)."""
    chosen = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in chosen.collect()), key=repr)


def bronze_rows(spark, table, rows):
    """A bronze table from partial rows; columns not given hold a neutral value."""
    schema = schemas.BRONZE[table]
    filled = [
        tuple(
            row[f.name] if f.name in row
            else "2025-01-01T00:00:00" if f.name == "ingest_ts"
            else DEFAULTS[f.dataType.simpleString()]
            for f in schema.fields
        )
        for row in rows
    ]
    return spark.createDataFrame(filled, schema)


def physical_plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def optimized_plan(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()
