"""Station telemetry on Spark: clean, sync, roll up and reconcile readings."""

from gaugeworks.session import build_session, tune, work_dir

__all__ = ["build_session", "tune", "work_dir"]
