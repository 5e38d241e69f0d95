"""Declared schemas: raw resources, vocabulary bundle, CDM tables."""
