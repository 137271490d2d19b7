"""Set-based operators over publication, artifact, page, cell and job tables."""
