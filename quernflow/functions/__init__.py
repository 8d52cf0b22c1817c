"""See the package README for the list of what lives here."""
