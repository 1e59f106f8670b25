"""How the operators combine into silver and gold tables, and the batch runner."""
