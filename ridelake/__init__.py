"""ridelake: ride-hailing lakehouse layers (raw, bronze, silver, gold) as Spark DataFrames."""
