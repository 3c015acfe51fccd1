"""The registered queries and their oracle SQL."""
