from shopmetrics.functions.core import (  # noqa: F401
    AS_OF,
    as_of_lit,
    half_up,
    half_even,
    money,
    whole_days,
    month_diff,
    pct,
    month_start,
)
