"""Run settings, and the fixed recodings of the monthly supervision form."""

from __future__ import annotations

import json
from dataclasses import dataclass, field

# Fixed value: identifier used where a category or attribute combination is not given.
DEFAULT_COMBO = "HllvX50cXC0"

# Questions added up, and questions halved, by the supervision form.
SUPERVISION_SUMS = [
    ["amoxy_qc_moins_de_1an", "amoxy_qc_1an_a_5ans"],
    ["paracetamol_500mg_moins1_qc", "paracetamol_500mg_1a3ans_qc", "paracetamol_500mg_3ansplus_qc"],
    ["casorientcs-5_f", "casorientcs-5_g"],
    ["casorientcs5plus_f", "casorientcs5plus_g"],
    ["cascontreorient-5_f", "cascontreorient-5_g"],
    ["cascontreorient5plus_f", "cascontreorient5plus_g"],
    ["casprestb-5_f", "casprestb-5_g"],
    ["cassusppalugrav-5_f", "cassusppalugrav-5_g"],
    ["cassusppalugrav5plus_f", "cassusppalugrav5plus_g"],
    ["castbconfirm-5_f", "castbconfirm-5_g"],
    ["caseffetindes-5_f", "caseffetindes-5_g", "caseffetindes5plus_f", "caseffetindes5plus_g"],
    ["pbrouge6-59_f", "pbrouge6-59_g", "pbjaune6-59_f", "pbjaune6-59_g"],
]
SUPERVISION_HALVES = ["sro_qc", "sro_si", "sro_sd", "sro_in", "sro_jrs"]

# yes/no questions and the names of the indicators made from them.
SUPERVISION_FLAGS = [
    ("minuteur_ari", "count yes minuteur_ari"),
    ("minuteur_ari", "count yes minuteur_ari 2"),
    ("muac", "count yes muac"),
    ("muac", "count yes muac 2"),
    ("poubelle_recep", "count yes poubelle_recep"),
    ("caissemedexiste", "count yes caissemedexiste"),
    ("caissesecure", "count yes caissesecure"),
]


@dataclass(frozen=True)
class Derivations:
    """Columns a form derives from its answers.

    ``sums`` lists the columns of each sum, ``halves`` the columns divided by two, ``flags`` pairs of
    (yes/no column, indicator name). Text that stands for yes and no can differ between forms.
    """

    sums: list[list[str]] = field(default_factory=list)
    halves: list[str] = field(default_factory=list)
    flags: list[tuple[str, str]] = field(default_factory=list)
    true_values: tuple[str, ...] = ("1", "yes")
    false_values: tuple[str, ...] = ("0", "no")


SUPERVISION_FORM = Derivations(SUPERVISION_SUMS, SUPERVISION_HALVES, SUPERVISION_FLAGS)


@dataclass(frozen=True)
class PointRules:
    """How a wide row becomes canonical points.

    ``unmapped_prefixes`` are the starts of unit ids that have no counterpart in the target; they
    belong to a deployment, so they have no default.
    """

    unmapped_prefixes: tuple[str, ...]
    default_combo: str = DEFAULT_COMBO
    row_id: str = "export_id"
    period: str = "periode"
    unit: str = "reference_externe"

    @property
    def ids(self) -> list[str]:
        return [self.row_id, self.period, self.unit]


@dataclass(frozen=True)
class RunSettings:
    """Settings file of a run."""

    form_id: int
    output_file_name: str
    unmapped_prefixes: tuple[str, ...]
    output_format: str = ".parquet"
    choices_to_labels: bool = True

    @property
    def stage_format(self) -> str:
        return self.output_format.lstrip(".")

    @classmethod
    def from_json(cls, text: str) -> RunSettings:
        known = {k: v for k, v in json.loads(text).items() if k in cls.__dataclass_fields__}
        known["unmapped_prefixes"] = tuple(known["unmapped_prefixes"])
        return cls(**known)
