"""Scoring of arriving files."""
