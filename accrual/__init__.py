"""Recruitment analytics for study-registry data, as DataFrame-to-DataFrame Spark functions."""

__version__ = "0.1.0"
