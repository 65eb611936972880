"""The batch jobs: clean, s0, s1, s2, gold, regional importance."""
