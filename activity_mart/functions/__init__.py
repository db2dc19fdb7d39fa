"""Column functions: everything here takes and returns a Spark Column."""
