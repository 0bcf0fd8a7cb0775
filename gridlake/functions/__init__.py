"""Column functions: unit formulas, wind, times, names and report text. All JVM-side built-ins."""
