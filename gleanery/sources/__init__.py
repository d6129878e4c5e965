"""Readers: article files, stop words, movie CSV, sensor CSV, plain tables."""
