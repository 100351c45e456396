"""Models and reports: functions from DataFrames to DataFrames."""
