"""Reading, landing and storing tables."""
