"""Join strategies and lineage cuts the optimizer cannot choose by itself."""
