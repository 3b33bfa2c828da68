"""Column → Column functions: cleaning, labels, periods, ratios and JSON. No Python UDFs."""
