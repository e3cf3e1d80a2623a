"""Clinical-trial and patient data as Spark DataFrames."""
