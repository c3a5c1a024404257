"""Column functions: normalising texts, units, links, tiers, dates and places."""
