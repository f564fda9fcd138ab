"""Land-cover analysis of airborne laser point clouds on Spark."""
