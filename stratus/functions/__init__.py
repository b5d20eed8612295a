from stratus.functions.dates import (  # noqa: F401
    am_pm, as_date_lit, date_from_id, date_id, day_name, hour12, is_leap_year,
    is_weekend, iso_dow, iso_week, month_end, month_name, month_start, next_month,
    parse_local_ts, part_of_day, time_12h, time_24h, time_id,
)
from stratus.functions.numeric import (  # noqa: F401
    avg2, clamp_nonneg, round2, sum2, sum_hours,
)
from stratus.functions.text import (  # noqa: F401
    contains_any, is_daily_limit, is_json_object, quota_text,
)
