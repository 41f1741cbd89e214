"""Column expressions: repair of ids, numbers, texts and times. Native only, so whole plans stay in generated code."""

from eventloom.functions.columns import (
    fill_from_regex,
    fill_literal,
    from_value_map,
    gestation_days,
    pad_suffix,
    prefixed,
    strip_zeros,
    to_number,
    week_start,
)
from eventloom.functions.times import align_time, combine_date_time, combine_parts, parse_time

__all__ = [
    "align_time", "combine_date_time", "combine_parts", "fill_from_regex", "fill_literal", "from_value_map", "gestation_days",
    "pad_suffix", "parse_time", "prefixed", "strip_zeros", "to_number", "week_start",
]
