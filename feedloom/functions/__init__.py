"""Column functions: no joins, no shuffles, all inside whole-stage codegen where Spark allows."""
