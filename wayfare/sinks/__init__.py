"""Writers; the only modules besides the stream runner that start jobs."""
