"""Credit-portfolio and collections analytics as Spark DataFrame operators."""
