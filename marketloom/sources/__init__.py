"""Table scans, landed JSON payloads and table writes."""
