"""Customer and order analytics as Spark DataFrame operators."""
