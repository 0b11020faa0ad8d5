"""rainloom: post-processing and verification of ensemble rainfall forecasts, and cleaning of rainfall data, as Spark DataFrames."""
