"""Operators for preparing training text: encoding, quality, deduplication, packing, fingerprints, URL rules."""
