"""The store hierarchy as one wide row per store version."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame

from tidemark.operators.lookup import Dimension, flatten_dimensions

# Dimension, the store column that points to it, its own key.
# The address is reached through the geo location, and the currency through
# the customer, whose columns carry their prefix by then.
STORE_DIMENSIONS = (
    ("address", "geo_location_rhid", "address_rhid"),
    ("store_type", "store_type_rhid", "store_type_rhid"),
    ("location_type", "location_type_rhid", "location_type_rhid"),
    ("ownership_type", "ownership_type_rhid", "ownership_type_rhid"),
    ("retail_district", "retail_district_rhid", "retail_district_rhid"),
    ("retail_region", "retail_region_rhid", "retail_region_rhid"),
    ("retail_territory", "retail_territory_rhid", "retail_territory_rhid"),
    ("distribution_center", "distribution_center_rhid", "distribution_center_rhid"),
    ("customer", "customer_rhid", "customer_rhid"),
    ("customer_type", "customer_type_rhid", "customer_type_rhid"),
    ("suboffice", "suboffice_rhid", "suboffice_rhid"),
    ("company", "company_rhid", "company_rhid"),
    ("timezone", "time_zone_rhid", "time_zone_rhid"),
    ("climate_region", "climate_region_rhid", "climate_region_rhid"),
    ("geo_location", "geo_location_rhid", "geo_location_rhid"),
    ("currency", "customer_currency_rhid", "currency_rhid"),
    ("region", "region_rhid", "region_rhid"),
)


def store_hierarchy(store: DataFrame, tables: Mapping[str, DataFrame], dimensions=STORE_DIMENSIONS) -> DataFrame:
    """The store with the columns of every dimension given in ``tables``, prefixed by its name."""
    joins = [Dimension(tables[name], on, key, name) for name, on, key in dimensions if name in tables]
    return flatten_dimensions(store, joins)
