"""Column-level building blocks: rule tables, classification, dates, text."""
