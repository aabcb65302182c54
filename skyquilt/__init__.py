"""Imagery-catalogue analytics and corpus operators on PySpark DataFrames."""
