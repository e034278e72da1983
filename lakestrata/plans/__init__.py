"""Query plans over the layers: business analytics (QRY-*), check reports (dq_*) and layer jobs."""
