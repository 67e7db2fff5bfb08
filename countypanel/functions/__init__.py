"""Column expressions; all of them are JVM built-ins that stay inside whole-stage codegen."""
