"""Typed feature contract (P2-P5): schema, projection, row validation.

A contract is a plain ``StructType``: a field's type says whether it is a text,
a whole number or a number, and its metadata carries the source column, the
closed range, a title and an example.  It compiles to a projection that renames
source columns to public names, and to a ``violations array<string>`` column, so
invalid rows are routed (quarantined with their reasons) instead of failing one
request at a time.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def entry(name: str, dtype: T.DataType, title: str, example, low: float | None = None, high: float | None = None,
          column: str | None = None) -> T.StructField:
    """One field of a contract; ``column`` is its source column (default: the same name)."""
    meta = {"column": column or name, "title": title, "example": example}
    if low is not None:
        meta["low"] = low
    if high is not None:
        meta["high"] = high
    return T.StructField(name, dtype, True, meta)


@dataclass(frozen=True)
class CrossRule:
    """``left <op> right`` must hold; ``message`` is reported otherwise."""

    left: str
    op: str
    right: str
    message: str


def is_text(f: T.StructField) -> bool:
    return isinstance(f.dataType, T.StringType)


def is_whole(f: T.StructField) -> bool:
    return isinstance(f.dataType, T.IntegerType)


def project(df: DataFrame, contract: T.StructType, target: str | None = None) -> DataFrame:
    """Select source columns under public names; optional target appended
    with a *strict* numeric cast (a bad value fails the job under ANSI mode)."""
    wanted = [f.metadata["column"] for f in contract] + ([target] if target is not None else [])
    absent = sorted(set(wanted) - set(df.columns))
    if absent:
        raise ValueError(f"cannot project onto the contract, the input lacks {', '.join(absent)}")
    cols = [F.col(f.metadata["column"]).alias(f.name) for f in contract]
    if target is not None:
        cols.append(F.col(target).cast("double").alias(target))
    return df.select(*cols)


_OPS = {
    "<=": lambda a, b: a <= b,
    "<": lambda a, b: a < b,
    ">=": lambda a, b: a >= b,
    ">": lambda a, b: a > b,
}


def violations(contract: T.StructType, rules: Sequence[CrossRule] = (), extra_keys: str | None = None,
               mistyped: str | None = None) -> Column:
    """``array<string>`` of every reason a row breaks the contract.

    Per field: required (non-null), numeric type (``try_cast`` must succeed;
    integers must be whole), range, non-empty trimmed text.  Cross-field rules
    run on the cast values and only when both sides are present.  ``extra_keys``
    names an array column of unknown keys, ``mistyped`` one of text fields that
    were given as something else.
    """
    checks: list[Column] = []
    for f in contract:
        raw = F.col(f.name)
        checks.append(F.when(raw.isNull(), F.lit(f"{f.name}: required")))
        if is_text(f):
            checks.append(F.when(F.length(F.trim(raw.cast("string"))) == 0, F.lit(f"{f.name}: empty")))
            continue
        num, low, high = raw.try_cast("double"), f.metadata.get("low"), f.metadata.get("high")
        checks.append(F.when(raw.isNotNull() & num.isNull(), F.lit(f"{f.name}: not a number")))
        if is_whole(f):
            checks.append(F.when(num != F.floor(num), F.lit(f"{f.name}: not an integer")))
        if low is not None:
            checks.append(F.when(num < F.lit(float(low)), F.lit(f"{f.name}: below {low:g}")))
        if high is not None:
            checks.append(F.when(num > F.lit(float(high)), F.lit(f"{f.name}: above {high:g}")))
    for r in rules:
        ok = _OPS[r.op](F.col(r.left).try_cast("double"), F.col(r.right).try_cast("double"))
        checks.append(F.when(~ok, F.lit(r.message)))
    arr = F.array_compact(F.array(*checks)) if checks else F.array().cast("array<string>")
    if mistyped is not None:
        arr = F.concat(arr, F.transform(F.col(mistyped), lambda k: F.concat(k, F.lit(": not a text"))))
    if extra_keys is not None:
        arr = F.concat(arr, F.transform(F.col(extra_keys), lambda k: F.concat(F.lit("unknown field: "), k)))
    return arr


def clean(contract: T.StructType) -> list[Column]:
    """Typed, whitespace-stripped contract columns (after validation)."""
    out = []
    for f in contract:
        if is_text(f):
            out.append(F.trim(F.col(f.name).cast("string")).alias(f.name))
        else:
            out.append(F.col(f.name).try_cast("double").cast(f.dataType).alias(f.name))
    return out


def validate(df: DataFrame, contract: T.StructType, rules: Sequence[CrossRule] = (), extra_keys: str | None = None,
             mistyped: str | None = None) -> DataFrame:
    """Append the ``violations`` column."""
    return df.withColumn("violations", violations(contract, rules, extra_keys, mistyped))


def route(validated: DataFrame) -> tuple[DataFrame, DataFrame]:
    """P5: (valid rows, quarantined rows with their reasons)."""
    ok = F.size("violations") == 0
    return validated.where(ok), validated.where(~ok)


#: Contract of the derived sales table, as the queries and streams use it.
SALES_CONTRACT = T.StructType([
    entry("neighborhood", T.StringType(), "Nation", "FRANCE"),
    entry("zoning", T.StringType(), "Market segment", "BUILDING"),
    entry("building_type", T.StringType(), "Order status", "O"),
    entry("grade", T.StringType(), "Order priority", "3-MEDIUM"),
    entry("acctbal", T.DoubleType(), "Account balance", 0.0, -1000, 10000),
    entry("living_area", T.DoubleType(), "Total quantity", 100.0, 1, 300),
    entry("basement_area", T.DoubleType(), "Returned quantity", 0.0, 0, 200),
    entry("rooms", T.IntegerType(), "Line count", 4, 1, 10),
    entry("frontage", T.DoubleType(), "Max discount", 0.05, 0, 0.1),
    entry("first_ship_year", T.IntegerType(), "First ship year", 1998, 1990, 2010),
    entry("last_ship_year", T.IntegerType(), "Last ship year", 1998, 1990, 2010),
    entry("sold_year", T.IntegerType(), "Valuation year", 2001, 1992, 2001),
])
SALES_RULES: tuple[CrossRule, ...] = (
    CrossRule("first_ship_year", "<=", "sold_year", "first_ship_year lies past sold_year"),
    CrossRule("last_ship_year", ">=", "first_ship_year", "last_ship_year lies ahead of first_ship_year"),
    CrossRule("last_ship_year", "<=", "sold_year", "last_ship_year lies past sold_year"),
)
