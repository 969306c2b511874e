"""gaugeloom: virtual-sensor data preparation, modelling and scoring on Spark DataFrames."""
