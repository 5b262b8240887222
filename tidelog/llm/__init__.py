"""Operators that prepare text corpora for training. Nothing else in tidelog imports this subpackage."""
