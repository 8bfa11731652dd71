from .calendar import calendar_columns, year_month
from .expressions import (classify, day_of_week0, days_between, flag_above, flag_at_least,
                          is_in_flag, is_weekend, kw_to_mwh, label_periods, map_codes,
                          mw_to_mwh, period_start, ratio, round_money, safe_div, season,
                          volatility_class)
from .parsing import blank_to_null, to_date_lenient, to_integral, to_number

__all__ = [
    "calendar_columns", "year_month", "classify", "day_of_week0", "days_between", "flag_above",
    "flag_at_least", "is_in_flag", "is_weekend", "kw_to_mwh", "label_periods", "map_codes",
    "mw_to_mwh", "period_start", "ratio", "round_money", "safe_div", "season", "volatility_class",
    "blank_to_null", "to_date_lenient", "to_integral", "to_number",
]
