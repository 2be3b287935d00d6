"""Operators for preparing training data: one module each, all ``DataFrame -> DataFrame``."""
