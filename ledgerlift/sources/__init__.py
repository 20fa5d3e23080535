"""Reading raw grids, dimensions and legacy tables; storing table snapshots."""
