"""Table operators: every one maps a DataFrame to a DataFrame (or several)."""
