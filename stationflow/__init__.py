"""Sensor-reading operators for PySpark, on batch tables and on streams."""

from stationflow.session import configure, scratch_path

__all__ = ["configure", "scratch_path"]
