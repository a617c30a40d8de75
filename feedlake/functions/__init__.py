"""Column expressions: hashing, sketches, noise, payload codecs."""
