"""Named query plans with their oracle SQL."""
