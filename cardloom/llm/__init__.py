"""Operators for preparing training text: filtering, language, duplicates, tokens, chat windows, packing, search."""
