"""wardflow: bedside-reading analytics and grounded guideline retrieval on PySpark."""
