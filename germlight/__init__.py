"""germlight: Spark-native single-cell microbial analytics."""

__version__ = "0.1.0"
