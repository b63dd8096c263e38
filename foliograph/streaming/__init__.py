"""Incremental refresh. The workload is batch: the only state kept between loads is a hash-keyed vector cache."""
