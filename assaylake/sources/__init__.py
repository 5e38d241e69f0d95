"""Readers for landing files, vocabulary bundles and mapping seeds."""
