"""Yearly enrolment profiles by gender, age band and region, on Spark DataFrames."""
