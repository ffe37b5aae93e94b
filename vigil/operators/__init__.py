"""Operators: parsing, features, clustering, evaluation, anomalies, online model."""
