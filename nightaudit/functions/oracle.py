"""Column helpers that keep Oracle semantics where Spark's differ.

All are plain Catalyst expressions (codegen'd, no Python per row).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def text_concat(*parts) -> Column:
    """Oracle ``a || b``: NULL parts count as empty strings.

    Plain ``str`` parts are literal text; pass columns as ``Column``.
    """
    return F.concat(*[F.lit(p) if isinstance(p, str) else F.coalesce(p, F.lit("")) for p in parts])


def ora_text(c) -> Column:
    """Oracle has no empty string: '' is NULL."""
    return F.nullif(col(c), F.lit(""))


def least_or_null(a, b) -> Column:
    """Oracle ``LEAST`` is NULL when any argument is NULL; Spark's skips NULLs."""
    a, b = col(a), col(b)
    return F.when(a.isNull() | b.isNull(), F.lit(None)).otherwise(F.least(a, b))


def profile_name(last="last", company="company") -> Column:
    """``NVL(last, company)``: the display name of a guest or company profile."""
    return F.coalesce(col(last), col(company))


def yn(cond: Column) -> Column:
    """'Y' when ``cond`` is true, else 'N' (unknown counts as false)."""
    return F.when(cond, F.lit("Y")).otherwise(F.lit("N"))


def to_char_int(c) -> Column:
    """``TO_CHAR(n, '990')`` with blanks removed: rounded integer with sign."""
    return F.round(col(c), 0).cast("int").cast("string")


def to_char_money(c) -> Column:
    """``TO_CHAR(n, '999999990D00')`` with blanks removed, '.' as decimal mark."""
    return col(c).cast("decimal(18,2)").cast("string")


def is_fractional(c) -> Column:
    """``TRUNC(x) <> x`` on an exact decimal."""
    return (col(c) % 1) != 0


def blank_to_null(df: DataFrame) -> DataFrame:
    """Normalise '' to NULL in every string column (Oracle reads them as NULL)."""
    return df.select([
        ora_text(f.name).alias(f.name) if isinstance(f.dataType, T.StringType) else F.col(f.name)
        for f in df.schema.fields
    ])
