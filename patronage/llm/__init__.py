"""Operators for training corpora: one module each, all on DataFrames of whole documents or pages."""
