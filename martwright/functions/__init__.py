"""Column functions: casts, calendar, exact measures and display texts."""
