from ledgerlark.functions.scalars import (  # noqa: F401
    asset_key,
    evaluate_once,
    half_up_ratio,
    join_same,
    parse_report_date,
    parse_locale_number,
    parse_percent,
    run_date_or_today,
    split_list,
    strict_iso_date,
    to_numeric,
    tolerant_float,
)
