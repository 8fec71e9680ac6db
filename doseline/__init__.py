"""Quarterly population stratification and service-dose analytics on Spark DataFrames."""
