"""countpanel: Spark-native analytics for sensor-count panels."""

__version__ = "0.1.0"
