"""feedloom: daily report feeds and captured web pages as Spark DataFrames."""
