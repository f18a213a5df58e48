"""Part of terrasift."""
