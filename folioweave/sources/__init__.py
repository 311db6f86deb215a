"""Page sources and link discovery."""
