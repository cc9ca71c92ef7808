"""Writers. Outputs are folders of part files: no result goes through one task."""
