"""portolan.plans."""
