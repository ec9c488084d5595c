"""Operators for preparing training data. Nothing else in the library
imports this subpackage; each module holds one operator and states its
results for nulls, empty texts, ties and repeated rows."""
