"""Technician alignment, wide and long at once."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lanewright.operators.reshape import unpivot_groups

# Technician slots of a location (label, column prefix) and their managers.
TECH_SLOTS = [
    ("GM", "gm_tech"),
    ("GM PM", "gm_pm_tech"),
    ("Food Equipment", "food_eqpt_tech"),
    ("HVAC/R", "hvacr_tech"),
    ("HVAC/R PM", "hvacr_pm_tech"),
    ("Landscape", "landscape_tech_one"),
    ("Landscape", "landscape_tech_two"),
    ("Landscape", "landscape_tech_three"),
    ("Landscape", "landscape_tech_four"),
]
MANAGERS = {"GM": "gm_mgr", "HVAC/R": "hvacr_mgr", "Landscape": "landscape_mgr"}
GROUPS = {"GM PM": "GM", "Food Equipment": "GM", "HVAC/R PM": "HVAC/R"}


def tech_group(tech_type):
    mapped = F.create_map(*[F.lit(x) for pair in GROUPS.items() for x in pair])
    return F.coalesce(mapped[tech_type], tech_type)


def technician_alignment(locations: DataFrame) -> DataFrame:
    """Every location row repeated per staffed technician slot, with the slot's manager.

    A location has one row, so its slots and managers are unrolled beside its other
    columns and nothing is shuffled.
    """
    groups = [(label, [p, f"{p}_uid", f"{p}_status", f"{p}_phone"]) for label, p in TECH_SLOTS]
    rows = unpivot_groups(
        locations.filter(~F.col("location_type_code").isin("G")), locations.columns, groups,
        ["tech_name", "tech_userid", "tech_status", "tech_phone"], "tech_type",
    )
    group = tech_group(F.col("tech_type"))
    manager = F.coalesce(*[F.when(group == g, F.col(c)) for g, c in MANAGERS.items()])
    return rows.withColumn("tech_manager", manager)
