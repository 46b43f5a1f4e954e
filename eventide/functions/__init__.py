from eventide.functions.timefmt import (
    dur_us, to_us, from_us, plus, floor_to, ceil_to, parse_time, format_time,
    format_window, format_pane, format_attribution, pane_time_text,
)

__all__ = [
    "dur_us", "to_us", "from_us", "plus", "floor_to", "ceil_to", "parse_time", "format_time",
    "format_window", "format_pane", "format_attribution", "pane_time_text",
]
