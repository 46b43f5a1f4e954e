from eventide.sources.text import scan_text, parse_score_lines, write_text, score_lines
from eventide.sources.tables import load, scores_from_events, arrival_log_from_events, EVENT_WATERMARK
from eventide.sources.arrival import tag_and_merge

__all__ = ["scan_text", "parse_score_lines", "write_text", "score_lines", "load", "scores_from_events",
           "arrival_log_from_events", "EVENT_WATERMARK", "tag_and_merge"]
