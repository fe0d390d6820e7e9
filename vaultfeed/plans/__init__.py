"""The named datasets: parts, policy feeds, claim feeds, and the run that writes them."""
