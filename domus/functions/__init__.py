"""Scalar column functions (built-in Spark expressions only; no Python UDFs)."""

from domus.functions.scalar import (  # noqa: F401
    bin_right_closed,
    digits_only,
    dround,
    escape_quotes,
    fingerprint,
    first_digit_run,
    indicator,
    inv_norm_cdf,
    json_path,
    ln_or_null,
    money_avg,
    name_part,
    price_after_currency,
    ratio,
    run_date_text,
    run_datetime_text,
    search_key,
    sig_round,
    zero_aware_log,
)
