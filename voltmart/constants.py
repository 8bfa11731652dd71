"""Fixed values that must equal the source project's for identical results.

Everything here is a plain constant; operators take these as default arguments
so callers can override them per table.
"""

from __future__ import annotations

import datetime as _dt
from decimal import Decimal

# ---------------------------------------------------------------- fixed values
# Price spike limit in NZD/MWh; a spike is price strictly above it.
SPIKE_LIMIT = Decimal("500")
# Half-hour trading period, hours.
HALF_HOUR = Decimal("0.5")
# kW over one half-hour to MWh: kw * 0.5 / 1000, written as one factor.
KW_HALF_HOUR_TO_MWH = Decimal("0.0005")
# Trading periods in a normal day; DST days have up to 50.
EXPECTED_PERIODS = 48
MAX_PERIOD = 50
# Wet-day and heavy-rain limits on the per-lake average precipitation (mm), inclusive.
WET_DAY_MM = Decimal("1.0")
HEAVY_RAIN_MM = Decimal("25.0")
# Volatility classes, first match wins:
#   Extreme  p95 > 1000 or spike periods >= 24
#   Stressed p95 > 300  or spike periods >= 6
#   Elevated spike periods >= 1
#   Calm     otherwise
VOLATILITY_RULES = (
    ("Extreme", Decimal("1000"), 24),
    ("Stressed", Decimal("300"), 6),
    ("Elevated", None, 1),
)
VOLATILITY_DEFAULT = "Calm"
# Rolling window lengths (rows) and lead offsets (rows).
ROLLING_LENGTHS = (7, 30)
LEAD_OFFSETS = (1, 3, 7, 14, 30)

# Renewable fuel codes.
RENEWABLE_FUEL_CODES = ("Hydro", "Geo", "Wind", "Wood")
# Fuel code -> fuel category, in rule order; anything else (and null) is 'Other'.
FUEL_CATEGORY_RULES = (
    (("Hydro",), "Hydro"),
    (("Geo",), "Geothermal"),
    (("Wind",), "Wind"),
    (("Gas", "Gas&Oil"), "Gas"),
    (("Coal",), "Coal"),
    (("Diesel",), "Diesel"),
    (("Wood",), "Wood / Biomass"),
)
FUEL_CATEGORY_DEFAULT = "Other"

# Emission factors, kg CO2 per MWh, by fuel category.
EMISSION_FACTORS = (
    ("Coal", 900),
    ("Diesel", 800),
    ("Gas", 400),
    ("Geothermal", 50),
    ("Hydro", 0),
    ("Other", 200),
    ("Wind", 0),
    ("Wood / Biomass", 0),
)

# Labelled date ranges (inclusive), first match wins, else null.
COVID_PERIODS = (
    (_dt.date(2020, 3, 26), _dt.date(2020, 4, 27), "Level 4 Lockdown"),
    (_dt.date(2020, 4, 28), _dt.date(2020, 5, 13), "Level 3"),
    (_dt.date(2021, 8, 17), _dt.date(2021, 9, 21), "Delta Level 4"),
    (_dt.date(2021, 9, 22), _dt.date(2021, 10, 4), "Delta Level 3"),
)

# Hydro catchment -> pricing node.
CATCHMENT_NODES = (
    ("waitaki", "BEN2202"),
    ("manapouri", "MAN2201"),
    ("clutha", "ROX2201"),
    ("waikato", "ARA2201"),
)

# Lakes: location, lake_name, catchment, island, latitude, longitude.
LOCATIONS = (
    ("lake_pukaki", "Lake Pukaki", "waitaki", "South", -44.07, 170.14),
    ("lake_tekapo", "Lake Tekapo", "waitaki", "South", -43.88, 170.52),
    ("lake_ohau", "Lake Ohau", "waitaki", "South", -44.25, 169.85),
    ("lake_hawea", "Lake Hawea", "clutha", "South", -44.55, 169.27),
    ("lake_manapouri", "Lake Manapouri", "manapouri", "South", -45.50, 167.35),
    ("lake_te_anau", "Lake Te Anau", "manapouri", "South", -45.20, 167.72),
    ("lake_taupo", "Lake Taupo", "waikato", "North", -38.78, 175.95),
)

# Southern-hemisphere seasons by month.
SEASON_MONTHS = (
    ((12, 1, 2), "Summer"),
    ((3, 4, 5), "Autumn"),
    ((6, 7, 8), "Winter"),
    ((9, 10, 11), "Spring"),
)

# Calendar dimension range (inclusive).
CALENDAR_START = _dt.date(2018, 1, 1)
CALENDAR_END = _dt.date(2026, 12, 31)

# Raw price file headers -> loaded names; the first four are required.
PRICE_COLUMN_MAP = (
    ("TradingDate", "trading_date"),
    ("TradingPeriodNumber", "trading_period"),
    ("PointOfConnectionCode", "node"),
    ("DollarsPerMegawattHour", "price"),
    ("LoadMegawatts", "load_mw"),
    ("GenerationMegawatts", "generation_mw"),
)
PRICE_REQUIRED = ("trading_date", "trading_period", "node", "price")

# Generation wide-file id columns (lower-cased) and period column prefix.
GENERATION_ID_COLUMNS = ("site_code", "poc_code", "nwk_code", "gen_code", "fuel_code", "tech_code", "trading_date")
PERIOD_PREFIX = "tp"

# Unique keys of the raw tables.
GENERATION_KEY = ("poc_code", "trading_date", "trading_period")
PRICE_KEY = ("trading_date", "trading_period", "node")
WEATHER_KEY = ("location", "time")

# Weather measures, in file order.
WEATHER_MEASURES = ("precipitation_sum", "rain_sum", "snowfall_sum",
                    "temperature_2m_mean", "temperature_2m_max", "temperature_2m_min")

# Texts that count as a missing cell in the raw CSV feeds (matched whole, case as given).
NA_TOKENS = ("", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A",
             "NA", "NULL", "NaN", "None", "n/a", "nan", "null")

# File-name patterns.
GENERATION_FILE_GLOB = "*_Generation_MD.csv"
CSV_FILE_GLOB = "*.csv"
