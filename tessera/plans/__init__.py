"""End-to-end jobs composed from the operators, and the inputs the query set runs on."""
