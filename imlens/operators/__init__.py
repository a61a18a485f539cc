"""Operators: sampling, featurisation, reduction, classification, metrics, checked joins."""
