"""Operators for large training corpora: each module takes DataFrames of documents and returns DataFrames."""
