"""Formula functions: validate, inspect, compile and apply formulas held as data."""
