from tidemark.functions.text import count_or_zero, date_and_time, minute_timestamp, wall_clock
from tidemark.functions.values import day_parts, month_label, older_than, whole_number

__all__ = [
    "count_or_zero",
    "date_and_time",
    "day_parts",
    "minute_timestamp",
    "month_label",
    "older_than",
    "wall_clock",
    "whole_number",
]
