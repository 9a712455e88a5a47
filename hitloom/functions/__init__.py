"""Column expressions; all built-in, so Catalyst sees through every one."""
