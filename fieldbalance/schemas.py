"""Column types of every input table, and the check applied when one is read.

``site_id`` leads every table so that joins, groups and windows split by site.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T


def _schema(**columns: tuple[T.DataType, bool]) -> T.StructType:
    return T.StructType([T.StructField(n, t, null) for n, (t, null) in columns.items()])


STRING, INT, DOUBLE = T.StringType(), T.IntegerType(), T.DoubleType()
DATE, INSTANT = T.DateType(), T.TimestampType()

LAYER_THICKNESS_CM = 20
LAYER_COLUMNS = [f"VWC_{top}_{top + LAYER_THICKNESS_CM}"
                 for top in range(0, 160, LAYER_THICKNESS_CM)]

SOIL_SHEET = _schema(
    site_id=(STRING, False), crop=(STRING, True), date=(INSTANT, True),
    plot=(STRING, True), irrigation=(INT, True), n_rate=(INT, True),
    **{name: (STRING, True) for name in LAYER_COLUMNS},
)
FLAG_SHEET = _schema(
    site_id=(STRING, False), date=(INSTANT, True), plot=(STRING, True),
    **{name: (INT, True) for name in LAYER_COLUMNS}, comments=(STRING, True),
)
IRRIGATION_DIARY = _schema(
    site_id=(STRING, False), crop=(STRING, True), date=(DATE, False),
    irrigation_1=(DOUBLE, True), irrigation_2=(DOUBLE, True),
)
CANOPY_SHEET = _schema(
    site_id=(STRING, False), crop=(STRING, False), sensor=(STRING, False),
    date=(DATE, False), irrigation=(INT, True), nitrogen=(INT, True),
    ndvi=(DOUBLE, True),
)
PET = _schema(site_id=(STRING, False), date=(DATE, False), pet=(DOUBLE, True))
RAIN = _schema(site_id=(STRING, False), date=(DATE, False), rain=(DOUBLE, True))
GROWTH_EVENT = _schema(site_id=(STRING, False), date=(DATE, False),
                       events=(STRING, False))


def validate(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Keep the declared columns in order; raise if one is absent or mistyped."""
    have = {f.name: f.dataType for f in df.schema.fields}
    wrong = [f"{f.name}: want {f.dataType.simpleString()}, "
             f"have {have[f.name].simpleString() if f.name in have else 'nothing'}"
             for f in schema.fields if have.get(f.name) != f.dataType]
    if wrong:
        raise ValueError("table does not fit its schema: " + "; ".join(wrong))
    return df.select(*schema.fieldNames())
