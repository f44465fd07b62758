"""Column builders: every function takes columns (or names) and returns a column."""

from stratastar.functions.calendar import CALENDAR_COLUMNS, calendar_attributes, day_flag, easter_sunday
from stratastar.functions.cleaning import (
    FIXED_TRUTHY,
    blank_to_null,
    clean_code,
    clean_lower,
    clean_text,
    date_or,
    flag,
    flag_present,
    fitted_text,
    float_text,
    full_name,
    id_text,
    int_or,
    number_or,
    source_text,
    to_date,
    to_decimal,
    to_int,
    to_timestamp,
    zero_to_null,
)
from stratastar.functions.finance import (
    annual_yield,
    capital_gain,
    commission_split,
    elapsed_days,
    instalment,
    occupancy,
    sale_amounts,
    simple_interest,
    tax_result,
)
from stratastar.functions import keys
from stratastar.functions.keys import UNKNOWN, date_key, month_start, surrogate_key, unknown_key

__all__ = [name for name in dir() if not name.startswith("_")]
