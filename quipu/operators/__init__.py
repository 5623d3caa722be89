"""Domain operators: functions from DataFrames and parameters to a DataFrame."""
