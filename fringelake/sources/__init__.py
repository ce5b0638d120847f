"""Readers: big-endian rasters, parameter and network text files, artifact tables."""
