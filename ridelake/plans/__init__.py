"""The models, layer by layer: functions from DataFrames to DataFrames."""
