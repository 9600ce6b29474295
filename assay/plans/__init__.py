"""Rule registries and end-to-end flows over directories of tables."""
