"""tidemill: composable Spark jobs from raw files and event feeds to modelled, analysed tables."""

from tidemill.session import build_session, scratch_path, tune

__all__ = ["build_session", "scratch_path", "tune"]
