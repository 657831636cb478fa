"""Column-level building blocks: exact rounding, shared measures, parsing, geodesy, text."""
