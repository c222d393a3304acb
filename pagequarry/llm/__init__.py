"""Operators for preparing training data: duplicates, languages, scores, secrets, packing, archives."""
