"""Corpus-building operators. Nothing outside this subpackage imports it."""
