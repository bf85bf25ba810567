"""gristmill: DNS rule-list processing on Spark DataFrames."""
