"""Readers of publication formats: each turns a column of bodies into rows, one pass, poison rows kept as errors."""
