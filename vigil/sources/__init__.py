"""Reading tables and payloads, writing runs."""
