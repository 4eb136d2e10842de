"""Column expressions: all built in, none raises on dirty input under ANSI mode."""
