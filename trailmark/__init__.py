"""Behaviour analytics on Spark: DataFrame operators from raw logs to profiles and recommendations."""
