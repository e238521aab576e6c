"""Column -> Column expressions. Nothing here starts a job or needs Python on the executors."""
