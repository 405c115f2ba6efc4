from clicklens.functions.columns import (
    bucket_label,
    csv_ids,
    date_range,
    epoch_micros_ntz,
    epoch_seconds_ntz,
    floor_seconds,
    format_epoch_ms,
    non_blank,
    ranked_json,
    to_epoch_ms,
)

__all__ = [
    "bucket_label", "csv_ids", "date_range", "epoch_micros_ntz", "epoch_seconds_ntz", "floor_seconds",
    "format_epoch_ms", "non_blank", "ranked_json", "to_epoch_ms",
]
