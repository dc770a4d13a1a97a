"""Lexicon building and text analytics as PySpark DataFrame and streaming jobs."""
