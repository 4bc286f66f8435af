"""DataFrame operators: frames in, lazy frames out."""
