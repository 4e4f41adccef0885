"""Operators on text corpora: scoring, filtering, duplicate removal, mixing, packing and web archives."""
