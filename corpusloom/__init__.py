"""corpusloom: a PySpark-native engine for curating and annotating text corpora."""
