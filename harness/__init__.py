"""The given test tables seen as retail inputs, and the SQL twins that check the results."""
