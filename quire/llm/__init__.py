"""Training-corpus operators; ``queries`` and ``oracles`` name what the entry module registers."""
