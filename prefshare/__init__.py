"""Customer preference features from package purchases, as Spark jobs.

Purchases are named through tariff tables, packages are binned into labelled
buckets, and every customer gets the share of their purchases that falls in
each bucket. All work is declared with the DataFrame API; tables stay tall
(one row per customer and package) until they are written.
"""
