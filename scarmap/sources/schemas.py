"""Declared schemas of stored tables."""

LABELS = "unosat_id string, aoi string, damage int, date date, ep int, lon double, lat double"
LABEL_PROPERTIES = "unosat_id string, aoi string, damage int, date string, ep int"
ORBITS = "valid_orbits string, best_orbit int, aoi string"
BUILDINGS_RAW = (
    "id string, sources string, class string, geometry binary,"
    " bbox struct<minX:double,minY:double,maxX:double,maxY:double>"
)
FEATURE = "type string, properties string, geometry string"
FEATURES = "array<struct<type:string,properties:string,geometry:string>>"
