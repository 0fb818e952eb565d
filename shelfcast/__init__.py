"""Retail planning feeds built from warehouse tables with Spark DataFrames."""
