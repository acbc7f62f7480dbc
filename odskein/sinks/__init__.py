"""Writers of the flow tables."""
