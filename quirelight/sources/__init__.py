"""Where pages, spans and labels come from."""
