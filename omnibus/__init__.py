"""Bus-network analytics expressed as Spark DataFrame plans."""
