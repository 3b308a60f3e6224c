"""packetmill: the data side of scanned freight packets as Spark DataFrames."""
