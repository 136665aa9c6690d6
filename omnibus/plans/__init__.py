"""Silver, gold, report and load plans."""
