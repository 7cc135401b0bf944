"""Operators for large text corpora: near duplicates, contamination, packing, tagging and scans."""
