"""axonlake: connectome snapshot analytics and corpus preparation on Spark DataFrames."""
