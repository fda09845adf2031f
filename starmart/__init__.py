"""starmart: build, check and report a star-schema data mart with Spark DataFrames."""
