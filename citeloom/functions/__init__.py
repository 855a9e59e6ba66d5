"""Column functions: identifiers, titles, names, dates."""
