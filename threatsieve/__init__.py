"""Spark-native scoring of download URLs found in web-access logs."""

__version__ = "0.1.0"
