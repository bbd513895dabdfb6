"""Customer-feedback analytics as DataFrame -> DataFrame operators on Spark."""
