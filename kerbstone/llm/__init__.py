"""Training-data operators: formatting, cleaning, matching and encoding of text corpora."""
