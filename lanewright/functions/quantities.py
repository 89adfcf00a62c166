"""Row formulas for cases, packs, cube, weight, retail and composite keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lanewright.functions.nulls import safe_ratio, strict_least

# Pack classes counted as whole cases, and the oversized-label rule.
CASE_PACK_TYPES = ["CASEPACK", "FULL_PALLET", "MIXED_PALLET"]
OVERSIZED_LABEL = "FDSC"
OVERSIZED_INCHES = 52

# Fixed value: trailer capacity in cubic feet.
TRAILER_CUBE = 2600


def non_breakpack_cases(
    qty: Column, pack_type: Column, label: Column, girth: Column
) -> Column:
    """Quantity if it ships as whole cases: by pack class, or an oversized label; else 0."""
    oversized = (label == OVERSIZED_LABEL) & (girth > OVERSIZED_INCHES)
    return F.when(pack_type.isin(CASE_PACK_TYPES) | oversized, qty).otherwise(F.lit(0))


def pack_volume(
    qty: Column, whole_unit: Column, whole_pack: Column, vendor_pack: Column, vendor_unit: Column
) -> Column:
    """Cube or weight of ``qty`` whole packs, never above what the vendor pack implies.

    A missing whole-pack figure falls back to the vendor pack; a missing vendor
    figure makes the result NULL.
    """
    by_vendor = safe_ratio(qty * whole_pack, vendor_pack) * vendor_unit
    return strict_least(F.coalesce(qty * whole_unit, by_vendor), by_vendor)


def round_up_packs(each_qty: Column, variable_weight: Column) -> Column:
    return F.round(each_qty / variable_weight + F.lit(0.4999))


def variable_weight_packs(each_qty: Column, variable_weight: Column, pack_qty: Column) -> Column:
    """Vendor packs: rounded up by weight for variable-weight items, else eaches per pack."""
    return F.when(variable_weight > 1, round_up_packs(each_qty, variable_weight)).otherwise(
        safe_ratio(each_qty, pack_qty)
    )


def variable_weight_units(each_qty: Column, variable_weight: Column, pack_qty: Column) -> Column:
    """Shipped units: whole packs times pack size for variable-weight items, else rounded eaches."""
    return F.when(
        variable_weight > 1, round_up_packs(each_qty, variable_weight) * pack_qty
    ).otherwise(F.round(each_qty.cast("decimal(18,2)")).cast("double"))


def utilisation(cube: Column, capacity: float = TRAILER_CUBE) -> Column:
    """Share of the trailer filled, at most 1; unknown cube stays unknown."""
    return strict_least(cube / capacity, F.lit(1.0))


def allocate(ordered: Column, part: Column, total: Column) -> Column:
    """Share of ``ordered`` falling to ``part`` of ``total``; all of it when nothing is known."""
    return F.coalesce(ordered * safe_ratio(part, total), ordered)


def vendor_key(number: Column, department: Column, sequence: Column) -> Column:
    """Single location number for a vendor: number, department and sequence digits side by side."""
    return number * 1000 + department * 10 + sequence


def extend_quantity(
    packs: Column, pack_qty: Column, pack_cube: Column, pack_weight: Column, unit_retail: Column,
    suffix: str,
) -> list[Column]:
    """Units, cube, weight and retail value of a number of vendor packs."""
    units = packs * pack_qty
    return [
        units.alias(f"unit_{suffix}"),
        (packs * pack_cube).alias(f"cube_{suffix}"),
        (packs * pack_weight).alias(f"wgt_{suffix}"),
        (units * unit_retail).alias(f"retail_{suffix}"),
    ]
