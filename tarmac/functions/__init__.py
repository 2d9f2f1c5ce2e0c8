"""Column expressions. Nothing here runs a job or touches a session setting."""
