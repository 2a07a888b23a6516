"""Operators: functions from DataFrames (plus column names) to DataFrames.

Most add to a plan only. Those that weigh a side before broadcasting it, read
an intermediate table more than once, iterate, or return a handful of numbers
run jobs when called, and say so; they cut intermediate tables with reliable
checkpoints and release what they persist."""
