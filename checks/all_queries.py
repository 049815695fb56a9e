from checks import q_catalog, q_geometry, q_publish, q_schema, q_sources, q_stats  # noqa: F401
