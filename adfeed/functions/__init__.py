"""Column functions: Column in, Column out, evaluated inside the JVM."""
