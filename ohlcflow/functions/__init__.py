"""Column functions: calendar, text repair, schema checks."""
