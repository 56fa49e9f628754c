"""Tables, files and feeds."""
