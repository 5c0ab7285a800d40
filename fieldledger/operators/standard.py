"""Extracted data products in one standard table."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from fieldledger.operators.columns import check_choice, require_columns
from fieldledger.schemas import DATA_TYPES, STANDARD_COLUMNS


def to_standard(df: DataFrame, data_type: str = "DATA_ELEMENT", domain_type: str = "AGGREGATED") -> DataFrame:
    """Extracted values as nine standard columns; those a data type lacks are null.

    A reporting rate has its id and rate in one text, parted by a dot.
    """
    check_choice(data_type, DATA_TYPES, "data type")
    if data_type != "DATA_ELEMENT":
        df = df.withColumnsRenamed({"pe": "period", "ou": "orgUnit"})
    columns = {name: F.lit(None).cast("string") for name in STANDARD_COLUMNS}
    needed = ["period", "orgUnit", "value"]
    if data_type == "DATA_ELEMENT":
        needed += ["dataElement", "categoryOptionCombo", "attributeOptionCombo"]
        columns["DX_UID"] = F.col("dataElement")
        columns["CATEGORY_OPTION_COMBO"] = F.col("categoryOptionCombo")
        columns["ATTRIBUTE_OPTION_COMBO"] = F.col("attributeOptionCombo")
    else:
        needed += ["dx"]
        columns["DX_UID"] = F.col("dx")
    if data_type == "REPORTING_RATE":
        parts = F.split("dx", r"\.")
        columns["DX_UID"] = F.get(parts, F.lit(0))
        columns["RATE_TYPE"] = F.get(parts, F.lit(1))
    require_columns(df, needed)
    columns["PERIOD"] = F.col("period")
    columns["ORG_UNIT"] = F.col("orgUnit")
    columns["VALUE"] = F.col("value")
    columns["DATA_TYPE"] = F.lit(data_type)
    columns["DOMAIN_TYPE"] = F.lit(domain_type)
    return df.select(*[col.alias(name) for name, col in columns.items()])
