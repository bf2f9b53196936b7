"""Column functions: text cleaning, tokens, word normalisers, numbers."""
