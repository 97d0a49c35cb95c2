"""Group large catalogs of items by numeric features, on Spark DataFrames."""
