"""Operators: DataFrame -> DataFrame functions for each layer of the pipeline."""
