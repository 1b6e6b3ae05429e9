"""Record linkage and catalogue synchronisation on Spark DataFrames."""
