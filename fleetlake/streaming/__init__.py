"""Loading as files land."""
