"""Communications and transaction surveillance on Spark DataFrames."""
