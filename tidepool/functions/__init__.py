"""Column expressions (distance, nearest centre, text checks, time)."""
