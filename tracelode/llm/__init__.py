"""Operators that prepare training text: scans, dedup, tokenisation, search, sharding."""
