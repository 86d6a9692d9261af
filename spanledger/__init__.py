"""Corpus analytics on PySpark: byte-accounted spans, joins, audits and graphs over whole tables."""
