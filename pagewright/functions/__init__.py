"""Part of pagewright; see the README for the layout."""
