"""Reading and writing: files, message logs and run state."""
