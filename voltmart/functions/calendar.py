"""Calendar attributes of a date column (the date dimension's columns)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .expressions import _col, day_of_week0, season


def calendar_columns(date_col: str | Column) -> dict[str, Column]:
    """Name -> expression for every date-dimension attribute, in output order."""
    d = _col(date_col)
    return {
        "year": F.year(d),
        "month_number": F.month(d),
        "month_name": F.date_format(d, "MMMM"),
        "quarter_in_year": F.quarter(d),
        "day_of_week": day_of_week0(d),
        "season": season(d, "title"),
        "is_weekend": day_of_week0(d).isin(0, 6),
        "month_year_label": F.date_format(d, "MMM yyyy"),
        "month_year_sort": F.year(d) * F.lit(100) + F.month(d),
        "week_number": F.weekofyear(d),
        "day_name_short": F.date_format(d, "E"),
    }


def year_month(date_col: str | Column) -> Column:
    """'yyyy-MM' label used where the source read an absent column (D1)."""
    return F.date_format(_col(date_col), "yyyy-MM")
