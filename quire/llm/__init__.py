"""Operators for corpus preparation. Nothing outside this subpackage imports it."""
