"""Operators over the tables of senses, words and variants."""
