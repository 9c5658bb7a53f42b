"""Tables read and written."""
