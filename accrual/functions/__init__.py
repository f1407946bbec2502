"""Column functions: every one is built-in Spark expressions, evaluated inside the JVM."""

from accrual.functions.ages import age_years
from accrual.functions.dates import duration_months, has_date, partial_date, recruitment_velocity
from accrual.functions.lists import (
    count_where,
    distinct_count,
    field_list,
    first_element,
    list_size,
    non_empty,
    pipe_joined,
)
from accrual.functions.numbers import flag_int, log_target, nan_to_null, percent, real_units
from accrual.functions.text import NON_DIAGNOSTIC_TERMS, any_term, clean_name, is_usable_facility

__all__ = [
    "NON_DIAGNOSTIC_TERMS",
    "age_years",
    "any_term",
    "clean_name",
    "count_where",
    "distinct_count",
    "duration_months",
    "field_list",
    "first_element",
    "flag_int",
    "has_date",
    "is_usable_facility",
    "list_size",
    "log_target",
    "nan_to_null",
    "non_empty",
    "partial_date",
    "percent",
    "pipe_joined",
    "real_units",
    "recruitment_velocity",
]
