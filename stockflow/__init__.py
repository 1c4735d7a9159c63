"""Retail stock analytics as Spark jobs."""

from stockflow.config import RetailConfig
from stockflow.session import build_session, prepare

__all__ = ["RetailConfig", "build_session", "prepare"]
