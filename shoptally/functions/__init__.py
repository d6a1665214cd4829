"""Column expressions: text, numbers, dates and calendar."""

from shoptally.functions.dates import as_of, calendar_parts, has_time, parse_date, week_end
from shoptally.functions.numbers import (
    dominant_role,
    encode_target,
    log_scale,
    ratio_or_null,
    rule_payment,
    safe_ratio,
    spend_by_role,
    split_tax,
    to_number,
    unlog_scale,
)
from shoptally.functions.text import normalize_id, normalize_text, payment_label

__all__ = [
    "as_of",
    "calendar_parts",
    "dominant_role",
    "encode_target",
    "has_time",
    "log_scale",
    "normalize_id",
    "normalize_text",
    "parse_date",
    "payment_label",
    "ratio_or_null",
    "rule_payment",
    "safe_ratio",
    "spend_by_role",
    "split_tax",
    "to_number",
    "unlog_scale",
    "week_end",
]
