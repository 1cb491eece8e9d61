"""Column builders: no joins, no actions, built-in Spark functions only."""
