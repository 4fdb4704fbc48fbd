from tallyworks.streaming.jobs import (
    change_log_stream,
    newest_sessions,
    scan_stream,
    session_windows,
    sessions,
    session_stream,
    unique_scans,
)

__all__ = [
    "change_log_stream",
    "newest_sessions",
    "scan_stream",
    "session_stream",
    "session_windows",
    "sessions",
    "unique_scans",
]
