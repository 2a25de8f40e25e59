"""Readers and writers: feature streams, boundary files, tile archives, elevation rasters."""
