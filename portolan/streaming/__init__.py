"""portolan.streaming."""
