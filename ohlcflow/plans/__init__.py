"""Request plan tables (GEN-3..5, JON-1)."""
