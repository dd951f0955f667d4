"""Column expressions: decoders, names, dates and format sniffing."""
