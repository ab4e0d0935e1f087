from tidemark.functions.columns import *  # noqa: F401,F403
from tidemark.functions.columns import (  # noqa: F401
    as_date, date_lit, ts_floor_lit, ymd_date, iso_prefix_date, week_w, year_week_w, weekday_w,
    week_start, safe_double, safe_long, sum0, ratio, pct_change, first_truthy, norm_key,
    is_total_row, thousands_dot, column_type_name, in_range,
)
