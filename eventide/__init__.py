"""eventide: event-time analytics (windows, triggers, panes, keyed state) on Spark."""

from eventide.session import get_session, checkpoint_dir

__all__ = ["get_session", "checkpoint_dir"]
