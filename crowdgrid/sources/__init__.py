"""Reading and writing messages and visit tables."""
