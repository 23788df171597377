"""Reading and writing: raw drops, layered tables and the shared scratch folder."""
