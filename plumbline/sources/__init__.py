"""Reading sources and writing targets."""
