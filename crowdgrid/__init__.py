"""Device-location analytics on Spark: decode, clean, bin, flag, cluster and trace pings."""
