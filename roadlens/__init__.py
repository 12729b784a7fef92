"""Road-network performance analytics expressed as Spark DataFrame operators."""
