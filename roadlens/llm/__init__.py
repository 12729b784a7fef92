"""Operators for preparing training data: toxicity, tokens, language, duplicates, search, archives, privacy, mixing."""
