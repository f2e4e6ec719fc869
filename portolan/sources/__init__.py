"""portolan.sources."""
