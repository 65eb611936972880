"""Site ranking on Spark: DataFrame operators and the batch jobs built from them."""
