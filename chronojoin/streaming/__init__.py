"""Incremental processing.  The reference has no stream operators; its
incremental work is the step-by-step refresh of a latest-row snapshot."""

from .refresh import latest_snapshot_end, materialize_incremental, merge_latest, refresh_latest

__all__ = ["latest_snapshot_end", "materialize_incremental", "merge_latest", "refresh_latest"]
