"""folioweave: stored HTML pages in, curated tables out, on Spark DataFrames."""
