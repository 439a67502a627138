"""Preparation and profiling of multilingual speech and text corpora, declared as Spark plans."""
