"""The analysis operators: functions from DataFrames to DataFrames."""
