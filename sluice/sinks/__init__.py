"""Writers of the control and log tables."""
