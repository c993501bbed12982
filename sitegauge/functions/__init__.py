from sitegauge.functions.calendar import (  # noqa: F401
    PeriodWindow,
    ReportingCalendar,
    earliest_window,
    reporting_calendar,
    trimester,
    trimester_of,
    wave_id,
)
from sitegauge.functions.columns import (  # noqa: F401
    clean_money,
    flag_label,
    growth,
    ieee_ratio,
    last_chars,
    nan_to_null,
    normalise_label,
    parse_money,
    split_part,
    text_month,
    text_year,
    title_case,
    us_date_text,
)
