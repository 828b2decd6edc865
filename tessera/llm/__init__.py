"""Operators for preparing large text corpora; nothing outside this subpackage imports it."""
