"""Operators on text and on near matches for training data. Nothing outside this subpackage imports it."""
