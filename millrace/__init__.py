"""millrace: data integration and reporting operators on Spark DataFrames."""
