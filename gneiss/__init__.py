"""gneiss: a PySpark-native engine for governed entity catalogs and corpus preparation."""
