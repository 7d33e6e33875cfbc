"""Operators: extracts, matching, zone tagging, reshaping, rollups, profiles."""
