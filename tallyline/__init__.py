"""Set-based subscription-billing analytics on Spark."""

from tallyline.session import build_session, configure, scratch_dir

__all__ = ["build_session", "configure", "scratch_dir"]
