"""Jobs that tie sources and operators together."""
