"""feedloom: a PySpark-native analytics engine for catalogs of open transit-data feeds."""
