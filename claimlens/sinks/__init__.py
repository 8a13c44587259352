"""Writers for stage outputs, results, audit log, exports and manifests."""
