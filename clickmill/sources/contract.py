"""Checking tables against their declared schema before they are used."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


class ContractError(ValueError):
    """A table does not have the columns its readers need."""


def schema_contract(
    table: DataFrame, name: str, expected: StructType, counts: bool = False
) -> DataFrame:
    """One row per column of the table or its declaration: both types and whether they agree.

    With ``counts`` also rows and NULLs, from one pass over every column of the table; without,
    these are NULL and nothing of the table is read.
    """
    declared = {f.name: f.dataType.simpleString() for f in expected}
    found = {f.name: f.dataType.simpleString() for f in table.schema}
    columns = list(declared) + [c for c in found if c not in declared]
    nothing = F.lit(None).cast("bigint")
    if counts:
        counted = table.agg(
            F.count(F.lit(1)).alias("rows"),
            *[F.count_if(F.col(f"`{c}`").isNull()).alias(f"nulls {c}") for c in found],
        )
    else:
        counted = table.sparkSession.range(1).select(
            nothing.alias("rows"), *[nothing.alias(f"nulls {c}") for c in found])
    checks = F.array(*[
        F.struct(
            F.lit(name).alias("table"),
            F.lit(c).alias("column"),
            F.lit(declared.get(c)).cast("string").alias("expected"),
            F.lit(found.get(c)).cast("string").alias("actual"),
            F.lit(declared.get(c) == found.get(c)).alias("ok"),
            F.col("rows"),
            (F.col(f"`nulls {c}`") if c in found else nothing).alias("nulls"),
        )
        for c in columns
    ])
    return counted.select(F.inline(checks))


def require_schema(table: DataFrame, name: str, expected: StructType) -> DataFrame:
    """The table itself, or ``ContractError`` naming every missing or mistyped column."""
    found = {f.name: f.dataType for f in table.schema}
    faults = [
        f"{f.name}: {found[f.name].simpleString() if f.name in found else 'missing'}"
        f" instead of {f.dataType.simpleString()}"
        for f in expected
        if found.get(f.name) != f.dataType
    ]
    faults += [f"{c}: not declared" for c in found if c not in expected.names]
    if faults:
        raise ContractError(f"{name}: " + "; ".join(faults))
    return table
