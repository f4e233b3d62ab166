"""Whole plans: packages, discovery, and the registered queries."""
