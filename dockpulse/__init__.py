"""Analytics for fleets of stations that report counts over time, on Spark DataFrames."""
