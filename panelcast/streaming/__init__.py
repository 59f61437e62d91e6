"""streaming of panelcast."""
