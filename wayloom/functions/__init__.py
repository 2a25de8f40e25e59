"""Column functions: grids, codecs, geometry, tag rules."""
