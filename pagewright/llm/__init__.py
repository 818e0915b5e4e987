"""Operators for text that goes into a training corpus; nothing outside this subpackage imports it."""
