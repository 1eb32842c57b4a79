"""Tabular cleaning, feature building and model comparison as plain DataFrame functions."""
