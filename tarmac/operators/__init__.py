"""Query operators: functions from DataFrames (and parameters) to lazy DataFrames."""
