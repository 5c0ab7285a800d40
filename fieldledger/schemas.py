"""Fixed schemas of the datasets that cross a file boundary, and their column lists."""

from __future__ import annotations

from pyspark.sql import types as T

_S, _I, _L, _B = T.StringType(), T.IntegerType(), T.LongType(), T.BooleanType()


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields.items()])


MAPPING = _struct(name=_S, data_element_id=_S, COC=_S, CC=_S, Calcul=_S)

POINT = _struct(
    PERIOD=_I,
    ORG_UNIT=_S,
    DX_UID=_S,
    CATEGORY_OPTION_COMBO=_S,
    ATTRIBUTE_OPTION_COMBO=_S,
    VALUE=_S,
    DATA_TYPE=_S,
)
POINT_KEYS = ["PERIOD", "ORG_UNIT", "DX_UID", "CATEGORY_OPTION_COMBO", "ATTRIBUTE_OPTION_COMBO"]

# The column order of a standard extract.
STANDARD_COLUMNS = [
    "DATA_TYPE",
    "DX_UID",
    "PERIOD",
    "ORG_UNIT",
    "CATEGORY_OPTION_COMBO",
    "ATTRIBUTE_OPTION_COMBO",
    "RATE_TYPE",
    "DOMAIN_TYPE",
    "VALUE",
]
# The data products that can be extracted.
DATA_TYPES = ["DATA_ELEMENT", "REPORTING_RATE", "INDICATOR"]

# Payload field for each canonical column, in payload order.
PAYLOAD_FIELDS = {
    "DX_UID": "dataElement",
    "ORG_UNIT": "orgUnit",
    "PERIOD": "period",
    "CATEGORY_OPTION_COMBO": "categoryOptionCombo",
    "VALUE": "value",
    "DATA_TYPE": "dataType",
    "ATTRIBUTE_OPTION_COMBO": "attributeOptionCombo",
}
# The fields of one published point, in payload order.
POINT_FIELDS = ["dataElement", "period", "orgUnit", "categoryOptionCombo", "attributeOptionCombo", "value"]

# Accepted import strategies.
IMPORT_STRATEGIES = ["CREATE", "UPDATE", "CREATE_AND_UPDATE"]
IMPORT_COUNTS = ["imported", "updated", "ignored", "deleted"]

DATA_ELEMENT_VALUES = _struct(
    dataElement=_S, period=_S, orgUnit=_S, categoryOptionCombo=_S, attributeOptionCombo=_S, value=_S
)
ANALYTICS_VALUES = _struct(dx=_S, pe=_S, ou=_S, value=_S)

ORG_UNIT = _struct(
    id=_S,
    name=_S,
    shortName=_S,
    openingDate=_S,
    closedDate=_S,
    parent=_struct(id=_S),
    level=_I,
    path=_S,
    geometry=_S,
    seq=_L,
)

REGISTRATION = _struct(organisationUnit=_S, period=_S, completed=_B, date=_S, dataSet=_S)
REGISTRATIONS = _struct(completeDataSetRegistrations=T.ArrayType(REGISTRATION))

PROCESSED = _struct(PERIOD=_I, ORG_UNIT=_S)

_COUNTS = _struct(**{name: _L for name in IMPORT_COUNTS})
_CONFLICT = _struct(object=_S, objects=T.MapType(_S, _S), value=_S, errorCode=_S)
_REPORT = T.MapType(_S, _S)
_DETAILS = {
    "importCount": _COUNTS,
    "conflicts": T.ArrayType(_CONFLICT),
    "errorReports": T.ArrayType(_REPORT),
    "rejectedIndexes": T.ArrayType(_I),
}
RESPONSE_BODY = _struct(
    responseType=_S,
    status=_S,
    description=_S,
    message=_S,
    dataSetComplete=_S,
    **_DETAILS,
    response=_struct(**_DETAILS),
)
RESPONSE = _struct(batch_id=_S, status_code=_I, body=_S)

AUDIT = _struct(
    period=_I, organization_unit=_S, extracted_count=_L, transformed_count=_L, pushed_count=_L
)
CHOICES = _struct(question=_S, code=_S, label=_S)
