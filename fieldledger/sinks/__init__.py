"""Writers of stage datasets, extracts, payloads and tables."""
