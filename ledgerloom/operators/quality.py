"""Data-quality operators: rejects by rule, keyed de-duplication, declared constraints, type narrowing."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def first_per_key(df: DataFrame, key: str | Sequence[str], ordinal: Sequence[str], copies: str | None = None) -> DataFrame:
    """One row per key, the first by ``ordinal`` (``dropDuplicates`` keeps an arbitrary one).

    An aggregate, so the copies of a hot key are reduced before the shuffle.
    With ``copies`` the number of rows each kept row stands for is added.
    """
    keys = [key] if isinstance(key, str) else list(key)
    rest = [c for c in df.columns if c not in keys and c not in ordinal]
    aggs = [F.min(F.struct(*ordinal, *rest)).alias("_row")]  # the ordinal leads, so it is held once
    keep = list(df.columns)
    if copies:
        aggs.append(F.count(F.lit(1)).alias(copies))
        keep.append(copies)
    out = df.groupBy(*keys).agg(*aggs)
    return out.select(*keys, "_row.*", *([copies] if copies else [])).select(*keep)


def last_per_key(df: DataFrame, key: str | Sequence[str], ordinal: Sequence[str]) -> DataFrame:
    """One row per key, the last by ``ordinal``."""
    keys = [key] if isinstance(key, str) else list(key)
    rest = [c for c in df.columns if c not in keys]
    row = F.max_by(F.struct(*rest), F.struct(*ordinal)).alias("_row")
    return df.groupBy(*keys).agg(row).select(*keys, "_row.*").select(*df.columns)


def drop_missing(df: DataFrame, columns: str | Sequence[str]) -> DataFrame:
    """Drop rows in which any of the columns is NULL."""
    cols = [columns] if isinstance(columns, str) else list(columns)
    return df.dropna("any", subset=cols)


def keep_known(df: DataFrame, column: str, known: DataFrame, known_column: str | None = None) -> DataFrame:
    """Rows whose value is in ``known``; a NULL value is rejected."""
    keys = known.select(F.col(known_column or column).alias(column)).distinct()
    return df.join(keys, column, "left_semi")


def tag_first_failure(df: DataFrame, rules: Sequence[tuple[str, Column]], name: str = "reject_rule") -> DataFrame:
    """Name of the first rule each row fails, NULL when it passes all of them."""
    out = None
    for rule, fails in rules:
        hit = F.coalesce(fails, F.lit(False))
        out = F.when(hit, rule) if out is None else out.when(hit, rule)
    return df.withColumn(name, out if out is not None else F.lit(None).cast("string"))


def reject_counts(tagged: DataFrame, name: str = "reject_rule") -> DataFrame:
    """Rows per rule in one pass; passed rows count as ``loaded``, so the sum is the input."""
    return tagged.groupBy(F.coalesce(F.col(name), F.lit("loaded")).alias("rule")).agg(F.count(F.lit(1)).alias("n_rows"))


def require_parsed(df: DataFrame, raw: str, parsed: str) -> DataFrame:
    """Fail with up to ten sample values when a column did not parse; else return ``df``."""
    bad = [r[0] for r in df.filter(F.col(parsed).isNull()).select(raw).distinct().limit(10).collect()]
    if bad:
        raise ValueError(f"could not read these values of {raw!r}: {bad}")
    return df


def assert_no_columns(df: DataFrame | Iterable[str], forbidden: Iterable[str]) -> None:
    """Fail when a feature set holds a column that is only known after the fact."""
    columns = df.columns if isinstance(df, DataFrame) else list(df)
    found = sorted(set(columns) & set(forbidden))
    if found:
        raise ValueError(f"columns known only after contact among the features: {found}")


@dataclass
class Constraints:
    """Declared rules of one table."""

    primary_key: Sequence[str] = ()
    not_null: Sequence[str] = ()
    checks: Mapping[str, Column] = field(default_factory=dict)
    max_length: Mapping[str, int] = field(default_factory=dict)
    foreign_keys: Mapping[str, tuple[DataFrame, str]] = field(default_factory=dict)


def check_constraints(df: DataFrame, spec: Constraints, table: str) -> DataFrame:
    """One row per declared rule with the number of rows that break it.

    Row-level rules share a single aggregate over the table. A CHECK that is
    NULL is satisfied, as in SQL.
    """
    rules: list[tuple[str, Column]] = [(f"not_null:{c}", F.col(c).isNull()) for c in spec.not_null]
    rules += [(f"check:{n}", ~cond) for n, cond in spec.checks.items()]
    rules += [(f"length:{c}", F.length(c) > n) for c, n in spec.max_length.items()]
    parts = []
    if rules:
        one = df.agg(*[F.count_if(F.coalesce(bad, F.lit(False))).alias(name) for name, bad in rules])
        parts.append(one.unpivot([], [F.col(f"`{n}`") for n, _ in rules], "rule", "violations"))
    if spec.primary_key:
        keys = list(spec.primary_key)
        dup = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
        null_key = F.lit(False)
        for k in keys:
            null_key = null_key | F.col(k).isNull()
        parts.append(
            dup.agg(F.coalesce(F.sum(F.when(null_key, F.col("n")).otherwise(F.col("n") - 1)), F.lit(0)).alias("violations"))
            .select(F.lit("primary_key:" + ",".join(keys)).alias("rule"), "violations")
        )
    for column, (parent, parent_key) in spec.foreign_keys.items():
        known = parent.select(F.col(parent_key).alias(column)).distinct()
        orphans = df.filter(F.col(column).isNotNull()).join(known, column, "left_anti")
        parts.append(orphans.agg(F.count(F.lit(1)).alias("violations")).select(F.lit(f"foreign_key:{column}").alias("rule"), "violations"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.select(F.lit(table).alias("table_name"), "rule", F.col("violations").cast("long").alias("violations"))


_INTS = [("tinyint", 2**7), ("smallint", 2**15), ("int", 2**31)]


def narrowed_types(df: DataFrame) -> dict[str, str]:
    """Smallest type that holds each numeric column, from one min/max pass.

    A double becomes a float only when every value survives the round trip.
    """
    ints = [f.name for f in df.schema if isinstance(f.dataType, (T.LongType, T.IntegerType, T.ShortType))]
    floats = [f.name for f in df.schema if isinstance(f.dataType, T.DoubleType)]
    if not ints and not floats:
        return {}
    aggs = []
    for c in ints:
        aggs += [F.min(c).alias(f"lo_{c}"), F.max(c).alias(f"hi_{c}")]
    for c in floats:
        exact = F.col(c).cast("float").cast("double").eqNullSafe(F.col(c))
        aggs.append(F.min(exact.cast("int")).alias(f"ok_{c}"))
    seen = df.agg(*aggs).first()
    out: dict[str, str] = {}
    for c in ints:
        lo, hi = seen[f"lo_{c}"], seen[f"hi_{c}"]
        if lo is None:
            continue
        for name, bound in _INTS:
            if -bound <= lo and hi < bound:
                out[c] = name
                break
    for c in floats:
        if seen[f"ok_{c}"] == 1:
            out[c] = "float"
    return out


def narrow_types(df: DataFrame) -> DataFrame:
    """Cast numeric columns to :func:`narrowed_types`; text is left to Parquet's dictionary."""
    to = narrowed_types(df)
    return df.select(*[F.col(c).cast(to[c]).alias(c) if c in to else F.col(c) for c in df.columns])
