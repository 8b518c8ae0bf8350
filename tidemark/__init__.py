"""Event analytics on Spark: one definition per operator, for tables and for streams."""
