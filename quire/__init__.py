"""Document-structuring and corpus-preparation engine on Spark DataFrames."""
