"""Layered catalogue analytics on Spark: DataFrame operators over keyed text layers."""

__version__ = "0.1.0"
SCHEMA_VERSION = "2.0"
