"""Column functions: ids, text, geometry, budgets, sets and evidence graphs. All stay in the JVM."""
