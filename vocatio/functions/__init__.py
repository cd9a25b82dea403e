"""Column functions: text rules, vector maths and model adapters."""
