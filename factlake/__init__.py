"""Structured financial-filing facts as Spark DataFrames: operators, sources, plans and streams."""
