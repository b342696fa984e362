"""DataFrame to DataFrame steps: cleaning, star tables, cards, checks."""
