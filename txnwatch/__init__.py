"""Bank transaction monitoring on Spark: SCD2 histories, valid-at joins, fraud rules."""
