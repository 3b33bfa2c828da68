"""DataFrame operators. Every function takes and returns lazy DataFrames; nothing here runs a job unless it says so."""
