"""A Spark-native engine for building, analysing and packaging bilingual lexicons."""
