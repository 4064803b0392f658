"""Operators that prepare text corpora for model training; nothing outside this folder imports it."""
