"""Catalogue curation and corpus preparation as Spark DataFrame plans."""
