"""Corpusloom: training-corpus preparation and evaluation as PySpark DataFrame jobs."""
