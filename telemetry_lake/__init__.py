"""Spark-native engine for fleet-telemetry lakes."""

from telemetry_lake.session import build_session, configure, scratch_path

__all__ = ["build_session", "configure", "scratch_path"]
