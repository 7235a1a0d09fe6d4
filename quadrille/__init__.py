"""Geo-cell analytics on Spark: adaptive partition, labelling, sampling and evaluation of geotagged tables."""
