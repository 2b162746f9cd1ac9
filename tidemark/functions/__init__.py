"""Column expressions: null-safe casts, ratios, buckets, text tokens, UDFs."""
