"""Column expressions; each takes and returns ``Column``."""
