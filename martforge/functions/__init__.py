"""Column expressions (all built-in Spark functions, no Python UDFs)."""

from martforge.functions.clean import (  # noqa: F401
    blank_to_null,
    normalize_email,
    parse_bool_text,
    parse_mixed_date,
    parse_money,
    line_total,
    money_sum,
    pct,
)
from martforge.functions.dates import (  # noqa: F401
    date_key,
    month_start,
    month_distance,
    day_of_week_sun0,
)
