"""Record cleaning rules of the ingest jobs, as Column expressions.

The reference stores a field only when it is truthy in Python: 0, 0.0, False,
'' and None all end up *absent*.  The comment count is the one exception and
falls back to 0.  These helpers keep that behaviour column-wise.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def falsy_number(c: Column | str) -> Column:
    """0 -> NULL (NaN is truthy in Python and is kept)."""
    return F.nullif(_col(c), F.lit(0))


def falsy_text(c: Column | str) -> Column:
    """'' -> NULL."""
    return F.nullif(_col(c), F.lit(""))


def falsy_bool(c: Column | str) -> Column:
    """Only TRUE survives; FALSE and NULL become NULL."""
    return F.when(_col(c), F.lit(True))


def zero_if_missing(c: Column | str) -> Column:
    """Falsy -> 0, used for the comment count."""
    return F.coalesce(falsy_number(c), F.lit(0)).cast("bigint")


def stringify(c: Column | str) -> Column:
    """Python ``str(x)``: text of the value, the word 'None' for a missing one."""
    return F.coalesce(_col(c).cast("string"), F.lit("None"))


def epoch_text(c: Column | str) -> Column:
    """Python ``str(float)`` of epoch seconds: '1704672000.0' for whole seconds.

    Spark prints doubles from 1e7 on in E-notation.  Its digits are the shortest that
    name the value, as Python's are; between 1e-3 and 1e16 they are written out, beyond
    that Python uses an exponent as well and Spark's text stays.
    """
    x = _col(c).cast("double")
    plain = x.cast("string").try_cast("decimal(38,21)").cast("string")
    plain = F.regexp_replace(F.regexp_replace(plain, "0+$", ""), r"\.$", ".0")
    written = (x == 0) | ((F.abs(x) >= F.lit(1e-3)) & (F.abs(x) < F.lit(1e16)))
    return F.when(written, F.coalesce(plain, x.cast("string"))).otherwise(x.cast("string"))


def drop_empty_records(df: DataFrame, fields: Sequence[str]) -> DataFrame:
    """Drop records in which none of ``fields`` survived cleaning."""
    return df.dropna(how="all", subset=list(fields))


def flag_adult_in_safe_community(post_adult: Column | str, community_adult: Column | str) -> Column:
    """Three-valued ``post_adult and not community_adult`` with Python's rules.

    Unknown post -> unknown; post not adult -> false; adult post -> true unless
    the community is known to be adult (an unknown community counts as not
    adult, as ``not None`` is True in Python).
    """
    a = _col(post_adult)
    b = _col(community_adult)
    return F.when(a.isNull(), F.lit(None).cast("boolean")).otherwise(
        a & ~F.coalesce(b, F.lit(False))
    )


# The same rules as SQL text, for projections issued as one select list
# (``DataFrame.selectExpr``): one JVM call for all fields instead of several
# per field.  ``tests/test_cleaning.py`` checks both forms agree.
def falsy_text_sql(name: str) -> str:
    return f"nullif(`{name}`, '')"


def falsy_number_sql(name: str) -> str:
    return f"nullif(`{name}`, 0)"


def falsy_bool_sql(name: str) -> str:
    return f"CASE WHEN `{name}` THEN true END"


def zero_if_missing_sql(name: str) -> str:
    return f"CAST(coalesce(nullif(`{name}`, 0), 0) AS BIGINT)"


# The flag rule as SQL text, for the SQL function of the streaming job.
FLAG_RULE_SQL = (
    "CASE WHEN post_adult IS NULL THEN CAST(NULL AS BOOLEAN) "
    "ELSE post_adult AND NOT coalesce(community_adult, false) END"
)
