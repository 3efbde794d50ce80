"""meterlens: Spark-native analytics for utility metering data."""

__version__ = "0.1.0"
