"""tidewell: public-data collection, merging and analytics on Spark DataFrames."""
