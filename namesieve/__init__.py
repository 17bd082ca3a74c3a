"""Entity-name resolution and risk scoring as Spark DataFrame operators."""
