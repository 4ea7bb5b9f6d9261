"""Academic-records warehouse and reporting engine on PySpark DataFrames."""
