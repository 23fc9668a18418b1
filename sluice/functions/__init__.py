"""Column functions shared by the operators; all stay inside the JVM."""
