"""Build and check a layered analytics store (bronze, silver, gold) on Spark DataFrames."""
