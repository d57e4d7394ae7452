from issuelens.functions.paths import variant_path
from issuelens.functions.scalars import (
    as_character, as_numeric, as_of_literal, days_between,
    flatten_newlines, hours_between, millis_to_minutes, nan_if_null, paste0,
    r_date, r_timestamp, strip_commas, strip_spaces, trim_ws,
)
from issuelens.functions.titlecase import status_name, title_case

__all__ = [
    "as_character", "as_numeric", "as_of_literal", "days_between",
    "flatten_newlines", "hours_between", "millis_to_minutes",
    "nan_if_null", "paste0", "r_date", "r_timestamp", "status_name", "strip_commas",
    "strip_spaces", "title_case", "trim_ws", "variant_path",
]
