"""Part of siltstone."""
