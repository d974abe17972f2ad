"""Workforce analytics as plain PySpark DataFrame functions."""

from rosterline.session import build_session, configure

__all__ = ["build_session", "configure"]
