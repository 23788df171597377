"""Column expressions: cleaning, exact money arithmetic and reproducible draws."""
