"""Where results go: tables, annotated matrices, extremes, masks, timings."""
