"""Spark-native building blocks for land-data tables and training corpora."""
