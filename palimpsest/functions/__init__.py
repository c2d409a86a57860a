from palimpsest.functions.dates import (
    day_utc, epoch_seconds, iso_week_start, sunday_week_start, whole_hours_between,
)
from palimpsest.functions.incidents import classify_incident
from palimpsest.functions.values import (
    clean_currency, clean_email, lead_time_bucket, row_image, surrogate_key, measured_text,
)

__all__ = [
    "classify_incident", "clean_currency", "clean_email", "day_utc", "epoch_seconds",
    "iso_week_start", "lead_time_bucket", "row_image", "sunday_week_start", "surrogate_key",
    "measured_text", "whole_hours_between",
]
