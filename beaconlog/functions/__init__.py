from .percentile import counted_percentile, grouped_percentile, join_same, value_percentile
from .scalar import (
    distinct_list,
    div0,
    epoch_timestamp,
    iff,
    is_error,
    iso_timestamp,
    iso_z,
    parse_double,
    parse_number,
    parse_timestamp,
    round_half_up,
    series_key,
    split_part,
    sql_list,
    sql_text,
    time_bin,
    uniform_int,
    whole_number,
)

__all__ = [
    "distinct_list",
    "div0",
    "epoch_timestamp",
    "counted_percentile",
    "grouped_percentile",
    "join_same",
    "value_percentile",
    "iff",
    "is_error",
    "iso_timestamp",
    "iso_z",
    "parse_double",
    "parse_number",
    "parse_timestamp",
    "round_half_up",
    "series_key",
    "split_part",
    "sql_list",
    "sql_text",
    "time_bin",
    "uniform_int",
    "whole_number",
]
