"""A Spark-native engine for raster, vector and evaluation analytics and for training-data preparation."""
