"""Catalogue matching, auditing and corpus preparation as Spark DataFrame plans."""
