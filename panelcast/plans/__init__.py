"""plans of panelcast."""
