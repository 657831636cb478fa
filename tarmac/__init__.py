"""Flight on-time analytics expressed as Spark DataFrame operators."""
