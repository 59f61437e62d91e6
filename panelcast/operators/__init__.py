"""operators of panelcast."""
