"""Operators of a training-data pipeline: archives, language, packing, leaks, filters, duplicates, search, chat."""
