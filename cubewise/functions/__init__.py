from cubewise.functions.columns import (  # noqa: F401
    county_from_centre,
    month_name,
    month_number,
    month_start,
    period_month,
    period_part,
    period_year,
    safe_cast,
    strip_county_prefix,
    trim_whitespace,
)
