"""Operators that prepare training data: mixing, language, near copies, shards, toxicity, and others."""
