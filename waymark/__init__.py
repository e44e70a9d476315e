"""Address gazetteer processing on Spark: load, shape, look up, release."""
