"""Declared data checks.

Checks that look at one row at a time become columns of a single aggregate over
the table. Checks that compare rows (unique, relationships) aggregate on their
own, map-side first. Every check yields a failing count; zero passes.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterline.operators.joins import orphans


@dataclass(frozen=True)
class RowCheck:
    """Rows for which ``broken`` is true fail."""
    name: str
    broken: Column


@dataclass(frozen=True)
class TableCheck:
    """``failing(df)`` gives a one-row, one-column frame with the failing count."""
    name: str
    failing: object


@dataclass(frozen=True)
class SchemaCheck:
    """``problems(df)`` lists what is wrong with the columns; no rows are read."""
    name: str
    problems: object


def not_null(column: str) -> RowCheck:
    return RowCheck(f"not_null({column})", F.col(column).isNull())


def accepted_values(column: str, values: list) -> RowCheck:
    """Null passes."""
    return RowCheck(f"accepted_values({column})", F.col(column).isNotNull() & ~F.col(column).isin(list(values)))


def non_negative(column: str) -> RowCheck:
    return RowCheck(f"non_negative({column})", F.col(column) < 0)


def positive(column: str) -> RowCheck:
    return RowCheck(f"positive({column})", F.col(column) <= 0)


def _repeated(df: DataFrame, columns: list[str], skip_null: bool) -> DataFrame:
    rows = df
    if skip_null:
        rows = rows.filter(reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in columns]))
    return rows.groupBy(*columns).agg(F.count("*").alias("_n")).filter("_n > 1").agg(F.count("*").alias("n"))


def unique(column: str) -> TableCheck:
    """Number of values held by more than one row; nulls are not compared."""
    return TableCheck(f"unique({column})", lambda df: _repeated(df, [column], True))


def unique_combination(columns: list[str]) -> TableCheck:
    """Like ``unique`` over several columns, but nulls count as a value."""
    return TableCheck(f"unique_combination({','.join(columns)})", lambda df: _repeated(df, list(columns), False))


def relationships(column: str, parent: DataFrame, parent_field: str) -> TableCheck:
    """Rows whose key is missing from the parent; null passes."""
    return TableCheck(f"relationships({column})",
                      lambda df: orphans(df, column, parent, parent_field).agg(F.count("*").alias("n")))


def query_equals(spark: SparkSession, sql: str, value) -> TableCheck:
    """A query's single value must equal ``value``; a query without a row fails."""
    def failing(_df):
        result = spark.sql(sql)
        same = F.col(result.columns[0]).eqNullSafe(F.lit(value))
        return result.agg((F.count_if(~same) + F.when(F.count("*") == 0, 1).otherwise(0)).alias("n"))
    return TableCheck(f"query_equals({sql.split()[0].lower()} ... = {value!r})", failing)


def schema_differences(found: T.StructType, wanted: T.StructType) -> list[str]:
    have = {f.name: f.dataType.simpleString() for f in found.fields}
    want = {f.name: f.dataType.simpleString() for f in wanted.fields}
    return ([f"missing {n}" for n in want if n not in have]
            + [f"unexpected {n}" for n in have if n not in want]
            + [f"{n} is {have[n]}, not {want[n]}" for n in want if n in have and have[n] != want[n]])


def contract(schema: T.StructType | str) -> SchemaCheck:
    """Column names and types must be exactly these; order is free."""
    def problems(df):
        wanted = df.sparkSession.createDataFrame([], schema).schema if isinstance(schema, str) else schema
        return schema_differences(df.schema, wanted)
    return SchemaCheck("contract", problems)


def required_columns(columns: list[str]) -> SchemaCheck:
    return SchemaCheck("required_columns", lambda df: [f"missing {c}" for c in columns if c not in df.columns])


def schema_unchanged(old: DataFrame, new: DataFrame) -> None:
    """Stop an incremental load whose columns drifted from the stored table's."""
    problems = schema_differences(new.schema, old.schema)
    if problems:
        raise ValueError("schema changed: " + "; ".join(problems))


def strict_json(df: DataFrame, column: str, schema: str) -> DataFrame:
    """Records and how many of them are not strict JSON (bare NaN included)."""
    parsed = F.from_json(F.col(column), f"{schema}, _broken string", {
        "allowNonNumericNumbers": "false", "columnNameOfCorruptRecord": "_broken"})
    return df.agg(F.count("*").alias("records"), F.count_if(parsed["_broken"].isNotNull()).alias("invalid"))


def freshness(df: DataFrame, ts: str, as_of, max_age: str) -> TableCheck:
    """Newest row must not be older than ``max_age`` before ``as_of``; all rows fail, and a table without rows."""
    oldest = F.lit(as_of).cast("timestamp") - F.expr(f"interval {max_age}")
    rows = F.count("*")
    return TableCheck(f"freshness({ts})", lambda table: table.agg(
        F.when(rows == 0, 1).when(F.coalesce(F.max(ts) < oldest, F.lit(True)), rows).otherwise(0).alias("n")))


@dataclass
class CheckResults:
    failing: dict[str, int]
    problems: dict[str, list[str]] = field(default_factory=dict)

    def failed(self) -> list[str]:
        return [n for n, count in self.failing.items() if count] + [n for n, p in self.problems.items() if p]

    def raise_on_failure(self) -> CheckResults:
        bad = self.failed()
        if bad:
            details = [f"{n}: {self.failing.get(n) or '; '.join(self.problems.get(n, []))}" for n in bad]
            raise ValueError("checks failed: " + " | ".join(details))
        return self


def check_counts(df: DataFrame, checks: list) -> DataFrame:
    """(check, failing) rows of all row and table checks, as one frame."""
    by_row = [c for c in checks if isinstance(c, RowCheck)]
    frames = []
    if by_row:
        folded = df.agg(*[F.count_if(c.broken).alias(f"c{i}") for i, c in enumerate(by_row)])
        pairs = F.array(*[F.struct(F.lit(c.name).alias("check"), F.col(f"c{i}").alias("failing"))
                          for i, c in enumerate(by_row)])
        frames.append(folded.select(F.inline(pairs)))
    for c in checks:
        if isinstance(c, TableCheck):
            counted = c.failing(df)
            frames.append(counted.select(F.lit(c.name).alias("check"), F.col(counted.columns[0]).alias("failing")))
    if not frames:
        return df.sparkSession.createDataFrame([], "check string, failing bigint")
    return reduce(lambda a, b: a.unionByName(b), frames)


def run_checks(df: DataFrame, checks: list) -> CheckResults:
    """Evaluate every check, then report; the build need not run with it."""
    problems = {c.name: c.problems(df) for c in checks if isinstance(c, SchemaCheck)}
    rest = [c for c in checks if not isinstance(c, SchemaCheck)]
    counts = {r["check"]: r["failing"] for r in check_counts(df, rest).collect()} if rest else {}
    return CheckResults(counts, problems)
