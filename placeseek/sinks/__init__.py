"""Sinks and actions."""

from placeseek.sinks.index import (
    append_to_index,
    collect_records,
    json_lines,
    preview,
    preview_then_append,
    register_view,
    write_json_lines,
)

__all__ = [
    "append_to_index",
    "collect_records",
    "json_lines",
    "preview",
    "preview_then_append",
    "register_view",
    "write_json_lines",
]
