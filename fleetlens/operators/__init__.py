"""Operators: DataFrame in, lazy DataFrame out. None of them runs a job."""
