"""praktika: council-records analytics as Spark DataFrame operators."""
