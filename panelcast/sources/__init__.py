"""sources of panelcast."""
