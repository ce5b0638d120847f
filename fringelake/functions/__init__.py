"""Column expressions; nothing here plans a shuffle."""
