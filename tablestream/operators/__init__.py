"""Table and stream operators as DataFrame functions."""
