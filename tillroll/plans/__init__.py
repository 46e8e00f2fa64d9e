"""Query registry: named Spark plans and their independent SQL oracles."""
