"""Corpus-preparation operators for training data (language id, dedup, rules, packing, ...).

Nothing else in the library imports this subpackage; it imports only the
general helpers (session, written tables) of the library.
"""
