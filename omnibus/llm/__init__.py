"""Training-data operators: filtering, near duplicates, decontamination, tokens, shards, archives."""
