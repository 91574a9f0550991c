"""Column functions: numbers, labels, fiscal dates, scales and rounding. Column in, Column out; no Python at run time."""
