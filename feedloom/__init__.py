"""feedloom: build, score and search a catalog gathered from many feeds, on Spark.

Every operator takes DataFrames and column names and returns a lazy DataFrame.
"""
