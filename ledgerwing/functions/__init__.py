"""Column-level building blocks; all JVM-side unless a docstring says otherwise."""
