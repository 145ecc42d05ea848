"""Observation analytics on Spark: DataFrame functions over tables of measurements."""
