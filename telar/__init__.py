"""telar: event-graph and corpus processing on Spark DataFrames."""
