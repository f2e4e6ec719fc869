"""portolan.operators."""
