"""Operators on whole DataFrames, written so that no task has to hold a hot key's rows."""
