"""glossaria: a Spark-native engine for lexical and annotation data."""
