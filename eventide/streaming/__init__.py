from eventide.streaming.attribution import stream_attribution
from eventide.streaming.native import (stream_session_sums, stream_session_sums_and_late, stream_window_sums,
                                       stream_window_sums_and_late)
from eventide.streaming.panes import stream_ledger, stream_panes
from eventide.streaming.sessions import stream_session_panes
from eventide.streaming.validity import stream_validity_windows
from eventide.streaming.watermark import asserted, observed

__all__ = ["asserted", "observed", "stream_attribution", "stream_ledger", "stream_panes", "stream_session_panes",
           "stream_session_sums", "stream_session_sums_and_late", "stream_validity_windows", "stream_window_sums",
           "stream_window_sums_and_late"]
