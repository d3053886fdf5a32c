"""Operators for preparing training data. Nothing else in feedlake imports this subpackage."""
