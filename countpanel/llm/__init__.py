"""Corpus operators for preparing text training data (ten operators and the
pipeline that chains five of them).  Nothing else in the library imports
this subpackage."""
