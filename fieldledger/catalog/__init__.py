"""Queries over the driver tables, each with the SQL that checks it."""

from fieldledger.catalog import (  # noqa: F401  (importing registers the queries)
    completion,
    facts,
    files,
    hierarchy,
    publishing,
    snapshot,
)
from fieldledger.catalog.registry import ORACLES, QUERIES  # noqa: F401
