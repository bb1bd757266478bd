"""Dataset-factory analytics expressed as Spark DataFrame plans."""
