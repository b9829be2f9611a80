"""Training-data operators: deduplication, decontamination, language ID, LM scoring,
secret scans, chat formatting and mixing. Nothing else in the library imports this package."""
