"""Header alignment, cleaning, file verdicts and filters."""
