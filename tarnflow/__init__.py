"""tarnflow: a PySpark-native engine for amplicon metadata, sequence reads and feature tables."""

__version__ = "0.1.0"
