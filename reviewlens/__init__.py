"""Review-text analytics on Spark: cleaning, labelling, tagging, scoring and evaluation."""
