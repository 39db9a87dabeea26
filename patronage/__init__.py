"""Customer retention and revenue analytics over an orders star schema, as Spark DataFrame operators."""
