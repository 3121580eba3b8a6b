"""recordwell: master-data cleaning, matching and enrichment on Spark DataFrames."""

__version__ = "0.1.0"
