"""Column expressions: fixed vocabularies, bins, flags, weights."""
