"""Column expressions: text, time, answer parsing. No Python UDFs."""

from .answers import answer_map, clamp_label, json_object_text
from .text import (
    blank_to_null,
    clean_array,
    clip,
    escape_regex,
    first_segment,
    hash_personal,
    is_not_blank,
    normalise,
    trim_spaces,
    whole_word_pattern,
)
from .time import epoch_to_instant, is_in_future, iso_prefix_timestamp, now_literal, to_day

__all__ = [
    "answer_map", "clamp_label", "json_object_text", "blank_to_null", "clean_array", "clip",
    "escape_regex", "first_segment", "hash_personal", "is_not_blank", "normalise",
    "trim_spaces", "whole_word_pattern", "epoch_to_instant", "is_in_future",
    "iso_prefix_timestamp", "now_literal", "to_day",
]
