"""Where records come from: paged documents and the deterministic generator."""
