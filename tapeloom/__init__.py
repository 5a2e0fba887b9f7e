"""Transcript analytics on Spark: timed segments to sentences, paragraphs, merged text and files."""
