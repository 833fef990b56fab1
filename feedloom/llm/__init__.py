"""Operators for cleaning large text collections. Nothing outside this subpackage imports it."""
