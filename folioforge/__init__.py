"""Curation analytics for scientific documents, expressed as Spark plans."""
