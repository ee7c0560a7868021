"""Operators of a training-data pipeline (packing, language id, search,
toxicity, licences, URL reputation, mixing, near duplicates, quality,
suffix de-duplication). Nothing else in the library imports this package."""
