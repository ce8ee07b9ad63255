"""Column builders (built-in expressions only, so they stay in codegen)."""

from bookdemand.functions.dates import days_between, half_year_index, is_weekend, iso_date, iso_instant, utc_day
from bookdemand.functions.draws import uniform_int, weighted_choice
from bookdemand.functions.ids import padded_code, uuid5
from bookdemand.functions.scoring import flag_bonus, tiered_bonus
from bookdemand.functions.timeofday import minutes_between, seconds_of_day, time_text

__all__ = [
    "days_between", "half_year_index", "is_weekend", "iso_date", "iso_instant", "utc_day",
    "uniform_int", "weighted_choice", "padded_code", "uuid5",
    "flag_bonus", "tiered_bonus", "minutes_between", "seconds_of_day", "time_text",
]
