"""Table schemas and fixed domain values."""

from __future__ import annotations

from pyspark.sql.types import (
    BooleanType,
    DataType,
    DoubleType,
    IntegerType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

TEXT, INT, DOUBLE, FLAG, TIME = StringType(), IntegerType(), DoubleType(), BooleanType(), TimestampType()


def _table(**columns: DataType) -> StructType:
    return StructType([StructField(name, kind) for name, kind in columns.items()])


# The closed domain of the catalogue's ``type`` column.
SCIENCE = "OBJECT"
CONTINUUM = "FLAT"
RASTER = "RASTER"
WEATHER = "WEATHER"
ARC = "ARC"
RAW_LOGS = "RAW_LOGS"
CCD_ON_TIMES = "CCD_ON_TIMES"
DICHROIC_REFERENCE = "DICHROIC_REFERENCE"
BINARY_OFFSET_MODEL = "BINARY_OFFSET_MODEL"
FILE_TYPES = (
    SCIENCE, CONTINUUM, RASTER, WEATHER, ARC, RAW_LOGS, CCD_ON_TIMES, DICHROIC_REFERENCE,
    BINARY_OFFSET_MODEL,
)

# Header cards of catalogue columns; any other column is looked up by its name.
HEADER_CARDS = {
    "type": "OBSTYPE",
    "run_id": "RUNID",
    "observation_id": "OBSID",
    "time_added": "TIME_ADDED",
    "time_creation": "UTC",
    "time_observation": "DATE-OBS",
    "exposure_seconds": "EXPTIME",
    "dark_seconds": "DARKTIME",
    "cass_rotation_angle": "ROTANGLE",
    "object_ra": "OBJRA",
    "object_dec": "OBJDEC",
}

# Fixed value: a flat below this size is a raster readout.
RASTER_BELOW_MB = 8

# Names and types of the stored tables' columns.
CATALOG = _table(
    file_path=TEXT, file_name=TEXT, type=TEXT, object=TEXT, object_ra=TEXT, object_dec=TEXT,
    run_id=TEXT, observation_id=TEXT, num_extensions=INT, num_data_extensions=INT,
    time_added=TIME, time_creation=TIME, time_observation=TIME, exposure_seconds=DOUBLE,
    dark_seconds=DOUBLE, altitude=DOUBLE, azimuth=DOUBLE, cass_rotation_angle=DOUBLE,
    filter=TEXT, channel=TEXT, detector=TEXT,
)
CATALOG_REQUIRED = ("file_path", "file_name", "type", "time_added")
# Columns that come from counting or from the file itself, never from a header card.
NOT_FROM_HEADER = ("file_path", "file_name", "time_added", "num_extensions", "num_data_extensions")

HEADER_ROWS = _table(
    file_path=TEXT, hdu=INT, image_no=INT, key=TEXT, vtype=TEXT, value_str=TEXT,
    value_double=DOUBLE, value_bool=FLAG, has_data=FLAG,
)

# Likewise.
WEATHER_ROWS = _table(
    time=TIME, wind_speed=INT, wind_direction=INT, temperature=DOUBLE, relative_humidity=INT, pressure=DOUBLE,
)
WEATHER_METRICS = ("temperature", "wind_speed", "wind_direction", "relative_humidity", "pressure")
WEATHER_REQUIRED = ("time", "wind_speed", "wind_direction", "temperature", "relative_humidity")

EVENT_ROWS = _table(
    channel=TEXT, time=TIME, zone=TEXT,
)
