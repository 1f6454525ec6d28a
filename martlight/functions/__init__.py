"""Column helpers (built-in expressions only, no UDFs): service family and
labels, number and date formatting, date arithmetic, and the
same helpers as session SQL functions."""
