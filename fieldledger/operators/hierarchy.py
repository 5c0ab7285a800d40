"""Alignment of a source hierarchy of organisation units with a target one."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from fieldledger.operators.keys import key_rows, keys_match


# The fields two units are compared on, and the last version without geometry.
COMPARED = ["id", "name", "shortName", "openingDate", "closedDate", "parent", "geometry"]
LAST_VERSION_WITHOUT_GEOMETRY = "2.32"


def canonical_geometry(col: Column) -> Column:
    """Geometry text with sorted keys and plain numbers; null for bad JSON."""
    return F.to_json(F.try_parse_json(col))


def version_parts(version: str) -> tuple[int, ...]:
    """Numeric parts of a version; a suffix such as ``-SNAPSHOT`` is ignored."""
    return tuple(int(part) for part in version.split("-")[0].split("."))


def takes_geometry(version: str) -> bool:
    """Whether a target of this version stores geometry."""
    return version_parts(version) > version_parts(LAST_VERSION_WITHOUT_GEOMETRY)


def prepare_units(units: DataFrame, version: str | None = None) -> DataFrame:
    """Units with canonical geometry, or none where the target version takes none."""
    if version is not None and not takes_geometry(version):
        return units.withColumn("geometry", F.lit(None).cast("string"))
    return units.withColumn("geometry", canonical_geometry(F.col("geometry")))


def last_units(units: DataFrame, order: str = "seq") -> DataFrame:
    """The last row of each id by ``order``.

    An aggregate, not a window: rows of one id are reduced before the shuffle, so an id with very
    many rows is no hot spot.
    """
    others = [c for c in units.columns if c not in ("id", order)]
    last = F.max(F.struct(order, *others)).alias("_last")
    # Structs with a map or variant cannot be ordered; units hold neither.
    return units.where(F.col("id").isNotNull()).groupBy("id").agg(last).select("id", "_last.*").select(*units.columns)


def is_valid_unit(require_parent: bool = True) -> Column:
    """Whether the mandatory fields are set; the strict form also asks for a parent."""
    valid = (
        F.col("id").isNotNull()
        & F.col("name").isNotNull()
        & F.col("shortName").isNotNull()
        & F.col("openingDate").isNotNull()
    )
    return valid & F.col("parent").isNotNull() if require_parent else valid


def unit_struct() -> Column:
    """A unit as sent: parent by id, geometry by type and coordinates, nulls left out."""
    geometry = F.try_parse_json("geometry")
    return F.struct(
        "id",
        "name",
        "shortName",
        "openingDate",
        "closedDate",
        F.when(F.col("parent.id").isNotNull(), F.struct(F.col("parent.id").alias("id"))).alias("parent"),
        F.when(
            F.try_variant_get(geometry, "$.type", "string").isNotNull(),
            F.struct(
                F.try_variant_get(geometry, "$.type", "string").alias("type"),
                F.try_variant_get(geometry, "$.coordinates", "variant").alias("coordinates"),
            ),
        ).alias("geometry"),
    )


def unit_payload(action: Column) -> Column:
    """JSON to send: the bare unit to create it, a list of one unit to update it."""
    unit = unit_struct()
    return F.when(action == "CREATE", F.to_json(unit)).otherwise(
        F.to_json(F.struct(F.array(unit).alias("organisationUnits")))
    )


def units_to_create(source: DataFrame, target: DataFrame, order: str = "seq") -> DataFrame:
    """Source units whose id the target lacks; repeated source rows stay."""
    known = key_rows(target.select("id", order), ["id"])
    given = source.where(F.col("id").isNotNull())
    return given.join(known, keys_match(given, known, ["id"]), "left_anti")


def units_to_update(source: DataFrame, target: DataFrame, order: str = "seq") -> DataFrame:
    """Units in both hierarchies that differ in a compared field; the last row of an id counts.

    Nulls are equal to each other, so a unit without a closing date does not look changed.
    """
    new, old = last_units(source, order), last_units(target, order)
    fields = [c for c in COMPARED if c != "id"]
    old = old.select(F.col("id").alias("_id"), F.struct(*fields).alias("_old"))
    joined = new.join(old, new["id"] == old["_id"])
    return joined.where(~F.struct(*fields).eqNullSafe(F.col("_old"))).drop("_id", "_old")


def alignment_actions(
    source: DataFrame,
    target: DataFrame,
    version: str | None = None,
    require_parent: bool = True,
    order: str = "seq",
) -> DataFrame:
    """What to send to align ``target`` with ``source``: ``action``, ``ou_id``, ``status``, ``payload``.

    A unit to create that lacks a mandatory field is reported ``NOTVALID`` and has no payload.
    """
    # Level and path are neither compared nor sent, so they are not shuffled either.
    sent = [*COMPARED, order]
    source, target = prepare_units(source.select(*sent), version), prepare_units(target.select(*sent), version)
    create = units_to_create(source, target, order).withColumn("action", F.lit("CREATE"))
    update = units_to_update(source, target, order).withColumn("action", F.lit("UPDATE"))
    actions = create.unionByName(update)
    sendable = (F.col("action") == "UPDATE") | is_valid_unit(require_parent)
    return actions.select(
        "action",
        F.col("id").alias("ou_id"),
        F.when(~sendable, "NOTVALID").otherwise("READY").alias("status"),
        F.when(sendable, unit_payload(F.col("action"))).alias("payload"),
    )


def alignment_report(actions: DataFrame, responses: DataFrame | None = None) -> DataFrame:
    """Report rows ``action, statusCode, status, response, ou_id``.

    ``responses`` has ``action``, ``ou_id``, ``status_code`` and ``body``; without it nothing was sent.
    """
    none = F.lit(None).cast("string")
    if responses is None:
        return actions.select(
            "action", F.lit(None).cast("int").alias("statusCode"), "status", none.alias("response"), "ou_id"
        )
    parsed = F.try_parse_json("body")
    answers = responses.select(
        F.col("action").alias("_action"),
        F.col("ou_id").alias("_ou"),
        "status_code",
        F.try_variant_get(parsed, "$.status", "string").alias("_status"),
        F.to_json(F.try_variant_get(parsed, "$.response", "variant")).alias("_response"),
    )
    joined = actions.join(
        answers, (actions["action"] == answers["_action"]) & (actions["ou_id"] == answers["_ou"]), "left"
    )
    status = F.when(F.col("status") == "NOTVALID", F.col("status")).otherwise(F.col("_status"))
    return joined.select(
        "action",
        F.col("status_code").alias("statusCode"),
        status.alias("status"),
        F.col("_response").alias("response"),
        "ou_id",
    )


def alignment_totals(report: DataFrame) -> DataFrame:
    """Rows per action and status."""
    return report.groupBy("action", "status").agg(F.count(F.lit(1)).alias("n_units"))
