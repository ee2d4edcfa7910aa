"""Trip-fact and event-stream analytics as plain PySpark functions."""

from meterline.session import build_session, prepare, work_path

__all__ = ["build_session", "prepare", "work_path"]
