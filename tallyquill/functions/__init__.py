"""Column expressions: text and identifiers, money, web addresses and cache headers."""
