from opslake.functions.exprs import (  # noqa: F401
    as_timestamps, clip, clip_low, combine_one_row, fmt_ts, join_null_safe, minutes_between,
    norm_category, parse_ts, pct, quantile, rate_true, seconds_between,
)
