"""End-to-end batch jobs over posts, flights, catalogues and observations."""
