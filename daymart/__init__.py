"""Event records linked to a daily series: cleaning, joining, star schema, reports."""
