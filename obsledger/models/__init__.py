"""Model jobs. Fits return small parameter frames or MLlib models; scoring is a projection."""
