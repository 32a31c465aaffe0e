"""Data contracts: column rules V1-V7 in one aggregate pass, and table constraints W5."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (ByteType, DoubleType, FloatType, IntegerType, LongType,
                               ShortType, StringType)

from fileflow.schemas import ColumnSpec

_INT_TYPES = (ByteType, ShortType, IntegerType, LongType)
_FLOAT_TYPES = (FloatType, DoubleType)
SAMPLE_SIZE = 5

# The texts that users of the checks see.
MESSAGES = {
    "missing": "Missing required column: '{column}'",
    "not_null": "Column '{column}' has {n} null values (not allowed)",
    "int_type": "Column '{column}' expected integer, got {got}",
    "float_type": "Column '{column}' expected float, got {got}",
    "max_length": "Column '{column}' has {n} values exceeding max length {limit}",
    "allowed_values": "Column '{column}' has invalid values: {samples}. Allowed: {allowed}",
    "summary": "Schema validation failed with {n} error(s):",
}


class SchemaValidationError(Exception):
    """Raised by ``raise_on_error`` when any rule fails."""


@dataclass
class Violation:
    column: str
    rule: str
    n_bad: int
    samples: list[str]
    message: str


def _q(c: str) -> str:
    return f"`{c}`"


def rule_exprs(df: DataFrame, specs: list[ColumnSpec]):
    """Static checks (V1, V3, V4) and the aggregate expressions for V2, V5, V6.

    Returns (static violations, [(column, rule, expr, spec)]).
    """
    static: list[Violation] = []
    dyn = []
    fields = {f.name: f for f in df.schema.fields}
    for spec in specs:
        if spec.name not in fields:
            if not spec.nullable:
                static.append(Violation(spec.name, "missing", 1, [],
                                        MESSAGES["missing"].format(column=spec.name)))
            continue
        c = F.col(_q(spec.name))
        dt = fields[spec.name].dataType
        if not spec.nullable:
            dyn.append((spec.name, "not_null", F.count_if(c.isNull()), spec))
        if spec.dtype.startswith("int") and not isinstance(dt, _INT_TYPES):
            static.append(Violation(spec.name, "int_type", 1, [], MESSAGES["int_type"].format(
                column=spec.name, got=dt.simpleString())))
        if spec.dtype.startswith("float") and not isinstance(dt, _FLOAT_TYPES):
            static.append(Violation(spec.name, "float_type", 1, [], MESSAGES["float_type"].format(
                column=spec.name, got=dt.simpleString())))
        if spec.max_length and isinstance(dt, StringType):
            # survey Q12: non-null strings are always checked
            dyn.append((spec.name, "max_length",
                        F.count_if(F.char_length(c) > F.lit(spec.max_length)), spec))
        if spec.allowed_values:
            dyn.append((spec.name, "allowed_values",
                        F.count_if(c.isNotNull() & ~c.isin(list(spec.allowed_values))), spec))
    return static, dyn


def _message(col: str, rule: str, n: int, spec: ColumnSpec, samples: list[str]) -> str:
    return MESSAGES[rule].format(column=col, n=n, limit=spec.max_length, samples=samples,
                                 allowed=spec.allowed_values)


def counts(df: DataFrame, specs: list[ColumnSpec]) -> DataFrame:
    """Every counting rule evaluated in ONE aggregate pass, long form (column, rule, n_bad).

    Static (schema-only) failures are included with n_bad = 1.
    """
    spark = df.sparkSession
    static, dyn = rule_exprs(df, specs)
    rows = [(v.column, v.rule, v.n_bad) for v in static]
    static_df = spark.createDataFrame(rows, "column string, rule string, n_bad long")
    if not dyn:
        return static_df
    wide = df.agg(*[e.cast("long").alias(f"v{i}") for i, (_, _, e, _) in enumerate(dyn)])
    pairs = ", ".join(f"'{c}', '{r}', v{i}" for i, (c, r, _, _) in enumerate(dyn))
    long = wide.selectExpr(f"stack({len(dyn)}, {pairs}) as (column, rule, n_bad)")
    return long.unionByName(static_df)


def bad_samples(df: DataFrame, spec: ColumnSpec, k: int = SAMPLE_SIZE) -> list[str]:
    """First ``k`` distinct disallowed values in sort order.

    Partial distinct then a bounded top-k: memory stays O(k) per task, whatever the
    number of bad values.
    """
    c = F.col(_q(spec.name))
    bad = df.select(c.cast("string").alias("v")) \
        .filter(F.col("v").isNotNull() & ~c.isin(list(spec.allowed_values)))
    return [r.v for r in bad.distinct().orderBy("v").limit(k).collect()]


def validate(df: DataFrame, specs: list[ColumnSpec]) -> list[Violation]:
    """Collect all violations (V7). One aggregate job, plus one bounded job per failing
    allowed-values rule for its samples."""
    static, dyn = rule_exprs(df, specs)
    out = list(static)
    if dyn:
        row = df.agg(*[e.cast("long").alias(f"v{i}") for i, (_, _, e, _) in enumerate(dyn)]) \
            .first()
        for i, (col, rule, _, spec) in enumerate(dyn):
            n = row[f"v{i}"] or 0
            if n > 0:
                samples = bad_samples(df, spec) if rule == "allowed_values" else []
                out.append(Violation(col, rule, n, samples, _message(col, rule, n, spec, samples)))
    order = {s.name: i for i, s in enumerate(specs)}
    out.sort(key=lambda v: order.get(v.column, 0))
    return out


def report(df: DataFrame, specs: list[ColumnSpec]) -> DataFrame:
    """Violations as a DataFrame with the ``violation`` schema."""
    from fileflow.schemas import VIOLATION
    vs = validate(df, specs)
    return df.sparkSession.createDataFrame(
        [(v.column, v.rule, int(v.n_bad), v.samples, v.message) for v in vs], VIOLATION)


def raise_on_error(df: DataFrame, specs: list[ColumnSpec]) -> None:
    vs = validate(df, specs)
    if vs:
        msg = MESSAGES["summary"].format(n=len(vs)) + "\n" + "\n".join(
            f"  - {v.message}" for v in vs)
        raise SchemaValidationError(msg)


# --- table constraints (W5) -------------------------------------------------------------

def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Key groups that occur more than once, with their size (PK / UNIQUE, A14).

    A grouped count: partial aggregation before the shuffle keeps hot keys cheap.
    """
    return df.groupBy(*[_q(k) for k in keys]).agg(F.count(F.lit(1)).alias("n")) \
        .filter(F.col("n") > 1)


def duplicate_summary(df: DataFrame, keys: list[str]) -> DataFrame:
    """Number of duplicated key groups and of surplus rows."""
    d = duplicate_keys(df, keys)
    return d.agg(F.count(F.lit(1)).alias("dup_groups"),
                 F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).cast("long").alias("surplus_rows"))


def orphans(child: DataFrame, parent: DataFrame, child_keys: list[str],
            parent_keys: list[str] | None = None) -> DataFrame:
    """Child rows whose non-null foreign key has no parent (FK, J4): a left-anti join.

    Spark picks broadcast when the parent's key set is small (AQE re-plans at run time),
    sort-merge otherwise; only the parent's key columns are read.
    """
    pk = parent_keys or child_keys
    p = parent.select(*[F.col(_q(a)).alias(f"_pk{i}") for i, a in enumerate(pk)]).distinct()
    cond = None
    for i, c in enumerate(child_keys):
        e = F.col(_q(c)) == F.col(f"_pk{i}")
        cond = e if cond is None else cond & e
    nonnull = None
    for c in child_keys:
        e = F.col(_q(c)).isNotNull()
        nonnull = e if nonnull is None else nonnull & e
    return child.filter(nonnull).join(p, cond, "left_anti")


def null_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """NOT NULL check: null count per column in one pass, long form."""
    wide = df.agg(*[F.count_if(F.col(_q(c)).isNull()).cast("long").alias(f"n{i}")
                    for i, c in enumerate(columns)])
    pairs = ", ".join(f"'{c}', n{i}" for i, c in enumerate(columns))
    return wide.selectExpr(f"stack({len(columns)}, {pairs}) as (column, n_null)")


def enforce(df: DataFrame, not_null: list[str] = (), unique: list[str] = ()) -> None:
    """Raise unless the NOT NULL and UNIQUE constraints hold; called before a publish."""
    if not_null:
        bad = [r.column for r in null_counts(df, list(not_null)).collect() if r.n_null]
        if bad:
            raise SchemaValidationError(f"null values in {bad}")
    if unique:
        r = duplicate_summary(df, list(unique)).first()
        if r.dup_groups:
            raise SchemaValidationError(f"{r.surplus_rows} repeated rows for the key {unique}")
