"""muster: service-uptake analytics over registers of providers, as Spark DataFrames."""
