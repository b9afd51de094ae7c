"""Opinion measurement over large collections of short texts, on Spark DataFrames."""
