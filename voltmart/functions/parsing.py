"""Lenient parsing: bad text becomes null instead of failing the job (ANSI-safe).

Each helper references its input once. Filters on parsed columns are pushed
below the projection that parses them, with the expression substituted in, so
a helper that mentioned its input ten times would be evaluated ten times per
row there.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .expressions import _col

# Supported date layouts (time parts after a space or 'T' are dropped):
#   yyyy-M-d, yyyy/M/d, yyyy.M.d, d/M/yyyy, d-M-yyyy, d.M.yyyy, yyyyMMdd
_DATE_TOKEN = r"^([0-9]{4}[-/.][0-9]{1,2}[-/.][0-9]{1,2}|[0-9]{1,2}[-/.][0-9]{1,2}[-/.][0-9]{4}|[0-9]{8})(?:[ T].*)?$"
# every layout but the ISO one, in one pattern: parts of the layouts that a text does not have are empty
_OTHER = r"^(?:([0-9]{1,2})[-/.]([0-9]{1,2})[-/.]([0-9]{4})|([0-9]{4})[/.]([0-9]{1,2})[/.]([0-9]{1,2})|([0-9]{4})([0-9]{2})([0-9]{2}))$"


def blank_to_null(c: str | Column) -> Column:
    """Trimmed text, with '' turned into null."""
    return F.nullif(F.trim(_col(c).cast("string")), F.lit(""))


def to_number(c: str | Column, dtype: str = "decimal(18,6)") -> Column:
    """Text to number; blank, unparseable, NaN and infinite values become null."""
    t = F.trim(_col(c).cast("string"))
    if dtype == "double":
        x = t.try_cast("double")
        return F.when(F.abs(F.nanvl(x, F.lit(float("inf")))) < F.lit(float("inf")), x)
    return t.try_cast(dtype)  # a decimal has no NaN/inf: those texts fail the cast


def to_integral(c: str | Column, dtype: str = "smallint") -> Column:
    """Text to a whole number ('3' and '3.0' -> 3); fractions and junk become null."""
    n = F.trim(_col(c).cast("string")).try_cast("decimal(38,10)")
    return F.when(n % F.lit(1) == F.lit(0), n.try_cast(dtype))


def to_date_lenient(c: str | Column, day_first: bool = True) -> Column:
    """Text to date over the supported layouts; time parts dropped, junk -> null.
    `day_first` reads 3/4/2024 as 3 April, else as 4 March."""
    token = F.regexp_extract(F.trim(_col(c).cast("string")), _DATE_TOKEN, 1)
    iso = F.regexp_replace(token, _OTHER, "$3$4$7-$2$5$8-$1$6$9" if day_first else "$3$4$7-$1$5$8-$2$6$9")
    return iso.try_cast("date")  # a token has a year, a month and a day, so the cast reads nothing shorter
